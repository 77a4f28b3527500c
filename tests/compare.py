"""Compare a Spark result with DuckDB: names, types, row count, values."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.sql(sql).to_arrow_table()


def rows_of(arrow) -> Counter:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return Counter(zip(*columns, strict=True))


def types_of(arrow) -> dict[str, str]:
    short = {"large_string": "string", "timestamp[ns]": "timestamp[us]"}
    return {f.name: short.get(str(f.type), str(f.type)) for f in arrow.schema}


def assert_same(got, want) -> None:
    assert types_of(got) == types_of(want)
    got_rows, want_rows = rows_of(got), rows_of(want)
    extra, lacking = got_rows - want_rows, want_rows - got_rows
    assert not extra and not lacking, (list(extra.items())[:3], list(lacking.items())[:3])


def collected(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
