"""What the plans must look like when the data is large or lopsided."""

import os
import re
import threading
from collections import Counter
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlparse
from uuid import uuid4

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalogue import QUERIES
from terrace import session
from terrace.operators import quality, store
from terrace.operators.joins import left_join, once_per_match
from terrace.operators.transforms import enrich
from terrace.plans.credit_risk import credit_risk_fact, gold_sql_spec, ordered_by_risk
from terrace.plans.runs import make_views
from terrace.plans.spec import load_spec
from terrace.session import few_rows, input_bytes, scratch, shared_dir, shuffle_settings, sized_for
from terrace.sources import read_source

# Small enough that the hot keys below count as skewed and nothing is broadcast.
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, settings):
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def run(df):
    """Rows and the plan that produced them."""
    rows = Counter(tuple(r) for r in df.collect())
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def stored(tmp_path):
    def store_as(df, name):
        df.write.parquet(str(tmp_path / name))
        return df.sparkSession.read.parquet(str(tmp_path / name))

    return store_as


def hot(spark, n, expression, tasks=8):
    return spark.range(0, n, 1, tasks).selectExpr(expression, "cast(id as string) AS v")


THIRD_ON_7 = "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k"


def test_left_join_splits_thousands_of_hot_keys_of_either_side(spark, stored):
    left = stored(spark.range(0, 5000, 1, 4).selectExpr("nullif(id, 3) AS k", "'l' AS l"), "l")
    right = stored(hot(spark, 150_000, "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id % 3000 ELSE id END AS k"), "r")
    for one, other in ((left, right), (right, left)):
        with conf(spark, SKEW):
            rows, plan = run(left_join(one, other, "k"))
            assert re.search(r"SortMergeJoin\(skew=true\).*Inner", plan)
            assert rows == run(one.join(other, "k", "left"))[0]


def test_left_join_has_one_plan_and_starts_no_job(spark, stored):
    left, right = stored(spark.range(50).withColumnRenamed("id", "k"), "l"), stored(hot(spark, 90, "id % 7 AS k"), "r")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    plan = left_join(left, right, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert len(tracker.getJobIdsForGroup()) == before
    assert plan.count("Join Inner") == 1 and plan.count("Join LeftAnti") == 1


def test_left_join_shuffles_its_left_side_once(spark, stored):
    left = stored(spark.range(0, 20_000, 1, 4).selectExpr("'l' AS l", "nullif(id % 9000, 3) AS k"), "l")
    right = stored(hot(spark, 20_000, "id % 5000 AS k"), "r")
    with conf(spark, SKEW):
        rows, plan = run(left_join(left, right, "k"))
        assert plan.count("ReusedExchange") == 1
        assert rows == run(left.join(right, "k", "left"))[0]


def test_the_inner_join_of_a_write_is_hashed_where_partitions_are_small(spark, stored):
    left = stored(spark.range(0, 20_000, 1, 4).selectExpr("id AS k", "'l' AS l"), "l")
    right = stored(hot(spark, 60_000, "id % 5000 AS k"), "r")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sized_for(spark, input_bytes(left, right)):
            rows, plan = run(left_join(left, right, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"ShuffledHashJoin.*Inner", plan) and not re.search(r"SortMergeJoin.*Inner", plan)
    assert rows == run(left.join(right, "k", "left"))[0]


def test_a_lookup_without_columns_is_not_joined_unless_keys_repeat(spark, stored):
    left = stored(hot(spark, 3000, "nullif(id % 50, 3) AS k"), "l")
    once = stored(spark.range(0, 40, 2).withColumnRenamed("id", "m"), "once")
    with conf(spark, SKEW):
        rows, plan = run(once_per_match(left, once, "k", "m"))
        assert "Join" not in plan and "Exchange" not in plan
        assert rows == run(left)[0]
        twice = once.union(once.where("m < 10")).union(spark.range(1).selectExpr("cast(NULL AS bigint)"))
        got = once_per_match(left, twice, "k", "m")
        assert got.columns == left.columns
        assert run(got)[0] == run(left.join(twice, left.k == twice.m, "left").select("k", "v"))[0]


def test_upsert_splits_a_hot_target_key(spark, stored, tmp_path):
    target = stored(hot(spark, 150_000, THIRD_ON_7), "t")
    source = stored(spark.range(0, 9000, 1, 4).selectExpr("id * 5 + 2 AS k", "'new' AS v"), "s")
    with conf(spark, SKEW):
        rows, plan = run(store.merged(target, source, "k", str(tmp_path / "repeated")))
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftOuter", plan) and "ReusedExchange" in plan
    assert rows[(7, "new")] == 50_000 + 1 * (7 % 3 != 0)
    assert sum(rows.values()) == 150_000 + source.join(target, "k", "left_anti").count()


def test_upsert_splits_hot_unmatched_source_keys(spark, stored, tmp_path):
    target = stored(hot(spark, 30_000, "id AS k"), "t")
    odd = "CASE id % 3 WHEN 0 THEN -5 WHEN 1 THEN NULL ELSE id + 20000 END AS k"
    source = stored(hot(spark, 150_000, odd), "s")
    with conf(spark, SKEW):
        rows, plan = run(store.merged(target, source, "k", str(tmp_path / "repeated")))
    assert len(re.findall(r"SortMergeJoin\(skew=true\)", plan)) >= 2
    assert sum(n for (k, _), n in rows.items() if k == -5) == 50_000
    assert sum(n for (k, _), n in rows.items() if k is None) == 50_000
    updated = source.join(target, "k", "left_semi").count()
    assert updated > 0 and sum(rows.values()) == 180_000 - updated


def test_upsert_has_one_plan_for_sources_of_any_size(spark, stored, tmp_path):
    target = stored(hot(spark, 50_000, "id AS k"), "t")
    whole = stored(hot(spark, 50_000, "id + 1000 AS k"), "s")
    few = stored(spark.createDataFrame([(1, "a"), (-1, "b")], "k bigint, v string"), "f")
    for source, n in ((whole, 51_000), (few, 50_001)):
        logical = store.merged(target, source, "k", "")._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Join LeftOuter") == 1 and logical.count("Join LeftAnti") == 1 and logical.count("Join ") == 2
        rows, plan = run(store.merged(target, source, "k", ""))
        assert sum(rows.values()) == n
    assert "BroadcastHashJoin" in plan and rows[(1, "a")] == rows[(-1, "b")] == 1


def test_enrichment_splits_missing_and_hot_lookup_keys(spark, stored):
    odd = "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE id END AS stock"
    left = stored(hot(spark, 150_000, odd), "l")
    lookup = stored(spark.range(0, 30_000, 1, 4).selectExpr("id AS m", "id * 2 AS price"), "m")
    with conf(spark, SKEW):
        out = enrich(left, lookup, "price", "collaterals.stock = market.m", "price")
        rows, plan = run(out)
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(rows.values()) == 150_000
    assert sum(n for (_, _, p), n in rows.items() if p == 14) == 50_000


def test_fact_splits_hot_clients_and_credits(spark, stored):
    clients = stored(
        spark.range(0, 2000, 1, 4).selectExpr(
            "id AS client_id", "'n' AS name", "'c' AS city", "id AS credit_score"
        ),
        "clients",
    )
    credits = stored(
        spark.range(0, 60_000, 1, 8).selectExpr(
            "id AS credit_id",
            "if(id % 3 = 0, 7, id % 2000) AS client_id",
            "'t' AS credit_type",
            "cast(id as string) AS total_amount_eur",
            "10.0D AS balance_amount_eur",
            "'ACTIVE' AS status",
        ),
        "credits",
    )
    pledges = stored(
        spark.range(0, 150_000, 1, 8).selectExpr(
            "if(id % 3 = 0, 7, id) AS credit_id", "'HOME' AS collateral_type", "id * 1.0D AS valuation_eur"
        ),
        "pledges",
    )
    with conf(spark, SKEW):
        fact = credit_risk_fact(clients, credits, pledges)
        rows, plan = run(fact)
    assert len(re.findall(r"SortMergeJoin\(skew=true\)", plan)) >= 2
    plain = credits.join(pledges, "credit_id", "left").join(clients, "client_id")
    assert sum(rows.values()) == plain.count()
    assert sum(n for r, n in rows.items() if r[3] == 7) == plain.where("credit_id = 7").count()


def test_fact_of_sql_text_splits_a_hot_credit(spark, stored, tmp_path):
    """Through the views of its spec, without ``gold_frame``."""
    database = f"t{uuid4().hex}_silver"
    store.ensure_database(spark, database, str(tmp_path / "lake"))
    frames = {
        "clients": "id AS client_id, 'n' AS name, 'c' AS city, 600 AS credit_score",
        "credits": "id AS credit_id, id AS client_id, 't' AS credit_type, 1.0 AS total_amount_eur, "
        "1.0 AS balance_amount_eur, 'ACTIVE' AS status",
        "collaterals": "if(id % 3 = 0, 7, id % 5000) AS credit_id, 'LAND' AS collateral_type, "
        "cast(id AS double) AS valuation_eur, id AS stock_id",
        "market": "id AS market_id",
    }
    for name, columns in frames.items():
        n = 150_000 if name == "collaterals" else 5000
        df = spark.range(0, n, 1, 8).selectExpr(*split_columns(columns))
        store.overwrite(spark, df, f"{database}.{name}", str(tmp_path / name))
    spec = load_spec(gold_sql_spec(database.removesuffix("silver")), {"catalog": "spark_catalog", "source_base": ""})
    with conf(spark, SKEW):
        names = make_views(spark, spec)
        rows, plan = run(spark.sql(spec["gold_sql"]).select("credit_id", "collateral_value_eur"))
    for name in names:
        spark.catalog.dropTempView(name)
    assert re.search(r"SortMergeJoin\(skew=true\)", plan) and "LeftOuter" not in plan
    assert sum(rows.values()) == 150_000 + 0 and sum(n for r, n in rows.items() if r[0] == 7) >= 50_000


def split_columns(text):
    """Expressions at the commas outside of brackets."""
    return re.split(r", (?![^(]*\))", text)


def test_sort_by_band_has_more_ranges_than_bands(spark, stored):
    fact = stored(
        spark.range(0, 30_000, 1, 4).selectExpr(
            "id AS client_id", "id AS credit_id", "if(id % 3 = 0, 'HIGH', 'LOW') AS overall_risk"
        ),
        "fact",
    )
    with conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ordered = ordered_by_risk(fact)
        used = ordered.select(F.spark_partition_id().alias("p")).distinct().count()
        bands = [r.overall_risk for r in ordered.collect()]
    assert used > 2 and bands == sorted(bands)


def test_rules_cost_one_job_each_way(spark, stored):
    df = stored(hot(spark, 10_000, "nullif(id % 10, 3) AS k").selectExpr("k", "v", "v AS w"), "d")
    rules = quality.rules_of({"data_quality": [{"column": c} for c in "kvwkvwkvwk"]})
    plan = df.agg(*quality.failure_counts(rules, df.columns))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("FileScan") == 1 and physical.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark, stored):
    df = stored(hot(spark, 1000, "nullif(id, 3) AS k").withColumn("w", F.lit(1)), "d")
    kept = quality.drop_failing(df, [quality.Rule("k")]).select("v")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k)]" in plan
    assert re.search(r"ReadSchema: struct<k:bigint,v:string>", plan)


def test_source_copies_are_removed_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    spark.range(1000).selectExpr("'same' AS a", "'row' AS b").write.option("header", True).csv(path)
    df = read_source(spark, {"source": {"path": path}})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate[^\n]*\n[^\n]*Exchange[^\n]*\n[^\n]*HashAggregate", plan)
    assert df.count() == 1


def test_shuffles_follow_the_input(spark, stored):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(spark, 10 << 20)[name] == own
    assert shuffle_settings(spark, 2000 << 30)[name] == "16000"
    large = shuffle_settings(spark, 100 << 40)
    assert large[name] == "50000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) > 1 << 30
    assert name not in shuffle_settings(spark, None)
    with sized_for(spark, 2000 << 30):
        assert spark.conf.get(name) == "16000"
    assert spark.conf.get(name, None) is None


def test_what_a_task_reads_does_not_grow_with_the_input(spark):
    names = ["advisoryPartitionSizeInBytes", "skewJoin.skewedPartitionThresholdInBytes"]
    names = [f"spark.sql.adaptive.{n}" for n in names]
    for size in (None, 10 << 20, 6 << 30, 2000 << 30):
        assert [shuffle_settings(spark, size)[n] for n in names] == [f"{16 << 20}b", f"{64 << 20}b"]
    before = [spark.conf.get(n, None) for n in names]
    with conf(spark, {k: SKEW[k] for k in names}):  # the session's own are kept where they are less
        assert [shuffle_settings(spark, 6 << 30)[n] for n in names] == [SKEW[n] for n in names]
    for n, value in zip(names, before, strict=True):
        if value is None:
            spark.conf.unset(n)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(spark, 6 << 30)[name] == "384"
    assert shuffle_settings(spark, 500 << 30)[name] == "16000"


@pytest.mark.parametrize("name", ["left_outer_join", "case_coalesce", "gold_risk_fact"])
def test_outer_joins_of_the_catalogue_run_with_bounded_tasks(spark, name, monkeypatch):
    seen, write = [], session.written

    def watched(df, place):
        seen.append(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        return write(df, place)

    monkeypatch.setattr(session, "written", watched)
    got = QUERIES[name](spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
    assert seen == [f"{16 << 20}b"] and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_input_size_is_that_of_the_files(spark, stored, tmp_path):
    df = stored(spark.range(1000), "with space")
    files = sum(f.stat().st_size for f in (tmp_path / "with space").glob("*.parquet"))
    assert input_bytes(df) == input_bytes(df.where("id > 5").groupBy("id").count()) == files
    assert input_bytes(df, df.join(df.withColumnRenamed("id", "k"), F.col("id") == F.col("k"))) == 3 * files
    assert input_bytes(spark.range(5)) > 0


def test_unknown_size_is_not_small(spark):
    unknown = spark.createDataFrame(spark.sparkContext.range(3).map(lambda i: (i,)), "k bigint")
    assert input_bytes(unknown) is None


def test_settings_of_two_threads_do_not_mix(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    inside, seen = threading.Event(), []

    def second():
        inside.wait()
        with sized_for(spark, 4000 << 30):
            seen.append(spark.conf.get(name))

    other = threading.Thread(target=second)
    other.start()
    with sized_for(spark, 2000 << 30):
        inside.set()
        other.join(0.3)
        assert spark.conf.get(name) == "16000"
    other.join()
    assert seen == ["32000"] and spark.conf.get(name, None) is None


class Conf(dict):
    """Stands in for a session of which only the settings are read."""

    conf = property(lambda self: self)


def test_shared_folder_comes_from_the_session():
    cluster = {"spark.master": "spark://host:7077"}
    assert shared_dir(Conf({**cluster, "spark.checkpoint.dir": "hdfs:///work/"})) == "hdfs:///work"
    cluster["spark.sql.warehouse.dir"] = "hdfs:///warehouse/"
    assert shared_dir(Conf(cluster)) == "hdfs:///warehouse/_work"


def test_scratch_folders_go(spark, tmp_path):
    with scratch(spark, "try") as place:
        spark.range(3).write.parquet(f"{place}/a")
        assert spark.read.parquet(f"{place}/a").count() == 3
    assert not Path(urlparse(place).path).exists()


def test_few_rows(spark):
    schema = pa.schema([("a", pa.string()), ("b", pa.int64())])
    df = few_rows(spark, [("a", None), (None, 2)], schema)
    assert df.dtypes == [("a", "string"), ("b", "bigint")]
    assert [tuple(r) for r in df.collect()] == [("a", None), (None, 2)]
    assert few_rows(spark, [], schema).count() == 0
