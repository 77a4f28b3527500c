import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrace.operators import quality
from tests.compare import collected


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(None, f"n{i}", "x") for i in range(7, 0, -1)]
        + [("c1", None, None), (None, None, None), ("c2", "b", None), ("c3", "a", "y")],
        "id string, name string, city string",
    )


def check(df, rules, identify_by="name", counts=None):
    return quality.run_checks(df, {"data_quality": rules, "identify_by": identify_by}, counts)


def test_no_rules(people):
    df, results = check(people, [])
    assert results == [] and df is people


def test_failing_rule_drops_rows_and_samples_ids_in_order(people):
    df, [result] = check(people, [{"column": "id", "check": "not_null"}])
    assert collected(df.select("id")) == [("c1",), ("c2",), ("c3",)]
    assert (result.rule, result.status, result.failed_rows) == ("id_not_null", "FAIL", 8)
    assert result.failed_ids == "name=None, name=n1, name=n2, name=n3, name=n4 ... and 3 more"


def test_passing_rule(people):
    df, [result] = check(people.where("id is not null"), [{"column": "id"}])
    assert (result.status, result.failed_rows, result.failed_ids) == ("PASS", 0, None)
    assert result.action == "drop_row"


def test_few_failures_have_no_suffix(people):
    _, [result] = check(people, [{"column": "name", "action": "report"}], "id")
    assert result.failed_ids == "id=None, id=c1"


def test_only_drop_row_removes_rows(people):
    df, [result] = check(people, [{"column": "id", "action": "report"}])
    assert df.count() == people.count() and result.status == "FAIL"


def test_rules_follow_each_other(people):
    rules = [{"column": "id"}, {"column": "city", "action": "report"}, {"column": "city"}, {"column": "city"}]
    df, results = check(people, rules)
    assert [r.failed_rows for r in results] == [8, 2, 2, 0]
    assert [r.failed_ids for r in results[1:]] == ["name=None, name=b"] * 2 + [None]
    assert collected(df) == [("c3", "a", "y")]


def test_unknown_column_counts_neither_way(people):
    df, results = check(people, [{"column": "nope"}, {"column": "ID"}, {"column": "name"}])
    assert [r.status for r in results] == ["ERROR", "FAIL", "FAIL"]
    assert results[0].failed_rows is None
    assert quality.summary(results) == {"dq_passed": 0, "dq_failed": 2}
    assert df.count() == 2


@pytest.mark.parametrize("identify_by", [None, "nope"])
def test_without_an_id_column(people, identify_by):
    _, [result] = check(people, [{"column": "id"}], identify_by)
    assert result.failed_ids == "no identifying column available ... and 3 more"


def test_observed_counts_are_used(people):
    _, [result] = check(people, [{"column": "id"}], None, {"rule_0": 0, "rows": 11})
    assert result.status == "PASS"


def test_samples_send_few_rows_per_task(people):
    rules = quality.rules_of({"data_quality": [{"column": "id"}, {"column": "city"}]})
    plan = quality.sample_ids(people, rules, [0, 1], "name")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_result_frame(spark, people):
    _, results = check(people, [{"column": "id"}, {"column": "nope"}])
    df = quality.result_frame(spark, "p", results)
    assert df.columns == [
        "pipeline_name",
        "rule",
        "status",
        "failed_rows",
        "failed_ids",
        "action",
        "checked_at",
    ]
    assert [(r.rule, r.status, r.failed_rows) for r in df.collect()] == [
        ("id_not_null", "FAIL", 8),
        ("nope_not_null", "ERROR", None),
    ]


cell = st.none() | st.sampled_from("ab")
table = st.lists(st.tuples(st.integers(0, 99), cell, cell), max_size=12)
some_rules = st.lists(
    st.tuples(st.sampled_from(["x", "y", "nope"]), st.sampled_from(["drop_row", "report"])), max_size=4
)


def one_by_one(rows, rules):
    """The same rules applied one after the other to plain rows."""
    position, results = {"x": 1, "y": 2}, []
    for column, action in rules:
        if column not in position:
            results.append(("ERROR", None, None))
            continue
        bad = sorted(r[0] for r in rows if r[position[column]] is None)
        text = ", ".join(f"id={i}" for i in bad[:5])
        if len(bad) > 5:
            text += f" ... and {len(bad) - 5} more"
        results.append(("FAIL", len(bad), text) if bad else ("PASS", 0, None))
        if action == "drop_row":
            rows = [r for r in rows if r[position[column]] is not None]
    return rows, results


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=table, rules=some_rules)
def test_one_pass_equals_rule_after_rule(spark, rows, rules):
    df = spark.createDataFrame(rows, "id int, x string, y string")
    kept, results = check(df, [{"column": c, "action": a} for c, a in rules], "id")
    want_rows, want = one_by_one(rows, rules)
    assert [(r.status, r.failed_rows, r.failed_ids) for r in results] == want
    assert collected(kept) == sorted(want_rows, key=str)
