"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times; its best time counts. Results
are written to a sink that discards them, so all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalogue import QUERIES  # noqa: E402
from catalogue.inputs import (  # noqa: E402
    orders_with_gaps,
    prefix,
    settings,
    work_folder,
    write_credit_sources,
    write_csv,
)
from terrace import run_all  # noqa: E402
from terrace.operators import quality  # noqa: E402
from terrace.plans.credit_risk import credit_risk_specs  # noqa: E402

HEADLINE = (
    "gold_risk_fact",
    "ordered_fact",
    "left_enrich",
    "left_outer_join",
    "case_coalesce",
    "inner_join",
    "source_dedup",
    "not_null_drop",
    "failed_id_sample",
    "overwrite_replace",
    "silver_first_load",
    "upsert_merge",
    "upsert_repeated_target_keys",
    "upsert_bucketed",
    "csv_to_silver",
    "credit_risk_run",
)


def rules(n: int):
    """``n`` rules over the columns of orders with gaps."""

    def run(spark: SparkSession, sf_dir: str):
        df = orders_with_gaps(spark, sf_dir)
        spec = {"data_quality": [{"column": df.columns[i % 4], "action": "report"} for i in range(n)]}
        return quality.result_frame(spark, "bench", quality.run_checks(df, spec)[1])

    return run


def reload_seconds(spark: SparkSession, sf_dir: str) -> float:
    """The reload of the enriched collaterals, its CSV files and first loads not counted."""
    base = work_folder(spark)
    write_credit_sources(spark, sf_dir, f"{base}/source")
    specs = [s for s in credit_risk_specs(prefix(base)) if s["pipeline_name"][:6] in ("market", "collat")]
    run_all(specs, settings(base), spark)
    lines = spark.read.csv(f"{base}/source/collaterals.csv", header=True).dropDuplicates(["collateral_id"])
    write_csv(lines, f"{base}/again/collaterals.csv")  # a reload may not repeat a key
    start = time.perf_counter()
    run_all(specs[1:], settings(base) | {"source_base": f"{base}/again"}, spark)
    return time.perf_counter() - start


def seconds(spark: SparkSession, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    work = f"{tempfile.gettempdir()}/bench-{uuid4().hex}"  # one machine: the warehouse holds all else
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    queries = {name: QUERIES[name] for name in HEADLINE}
    queries |= {f"dq_rules_{n}": rules(n) for n in (1, 5, 10)}
    times = {}
    for name, query in queries.items():
        seconds(spark, query, sf_dir)
        times[name] = round(min(seconds(spark, query, sf_dir) for _ in range(runs)), 3)
    times["enriched_reload"] = round(min(reload_seconds(spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
