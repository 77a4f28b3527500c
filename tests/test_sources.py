import pytest
from pyspark.errors import AnalysisException

from terrace.sources import read_csv, read_marked_csv, read_source


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return str(path)

    return write


def test_every_column_is_a_string(spark, csv):
    df = read_csv(spark, csv("id,amount,day\n1,2.5,2024-01-01\n"))
    assert df.dtypes == [("id", "string"), ("amount", "string"), ("day", "string")]
    assert rows(df) == [("1", "2.5", "2024-01-01")]


def test_line_ends_empties_and_ragged_lines(spark, csv):
    text = 'a,b,c\r\n1,,x\r\n2,"",y\r\n3\r\n4,p,q,r\r\n5, s ,t\r\n'
    assert rows(read_csv(spark, csv(text))) == [
        ("1", None, "x"),
        ("2", None, "y"),
        ("3", None, None),
        ("4", "p", "q"),
        ("5", " s ", "t"),
    ]


def test_columns_are_picked_by_name_and_reordered(spark, csv):
    df = read_csv(spark, csv("a,b,c\n1,2,3\n"), ["c", "a"])
    assert df.columns == ["c", "a"]
    assert rows(df) == [("3", "1")]


def test_unknown_column_is_an_error(spark, csv):
    with pytest.raises(AnalysisException):
        read_csv(spark, csv("a,b\n1,2\n"), ["a", "nope"])


def test_without_header_columns_go_by_position(spark, csv):
    df = read_csv(spark, csv("1,2\n3,4\n"), ["x", "y"], has_header=False)
    assert df.columns == ["x", "y"]
    assert rows(df) == [("1", "2"), ("3", "4")]


def test_copies_are_removed_after_the_projection_with_nulls_equal(spark, csv):
    path = csv("a,b,c\n1,,x\n1,,y\n1,2,z\n,,p\n,,q\n")
    df = read_source(spark, {"source": {"path": path, "columns": ["a", "b"]}})
    assert rows(df) == sorted([("1", None), ("1", "2"), (None, None)], key=str)


def test_all_columns_without_a_list(spark, csv):
    df = read_source(spark, {"source": {"path": csv("a,b\n1,2\n1,2\n")}})
    assert rows(df) == [("1", "2")]


@pytest.mark.parametrize("header", [True, False])
def test_malformed_lines_are_marked(spark, csv, header):
    text = "1,2,3\r\n4\r\n5,6,7,8\r\n9,,\r\n\"a,b\",c,d\r\n"
    path = csv("x,y,z\r\n" * header + text)
    want = [("1", "3", False), ("4", None, True), ("5", "7", True), ("9", None, False), ("a,b", "d", False)]
    if header:
        assert rows(read_marked_csv(spark, path, ["x", "z"])) == want
    else:
        df = read_marked_csv(spark, path, ["x", "y", "z"], has_header=False)
        assert rows(df.drop("y")) == want


def test_a_row_is_malformed_if_one_of_its_lines_is(spark, csv):
    path = csv("a,b\n1,2\n1,2,3\n1,2\n4,5\n")
    df = read_source(spark, {"source": {"path": path, "columns": ["a", "b"], "malformed": "report"}})
    assert rows(df) == [("1", "2", True), ("4", "5", False)]
