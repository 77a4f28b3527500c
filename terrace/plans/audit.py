"""Audit tables: one row per run, one row per rule result."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from terrace.operators import quality, store
from terrace.session import few_rows

# The columns of the run log.
COUNTS = ["source_count", "bronze_count", "silver_count", "gold_count", "dq_passed", "dq_failed"]
RUN_SCHEMA = pa.schema(
    [
        ("pipeline_name", pa.string()),
        ("status", pa.string()),
        ("start_time", pa.string()),
        ("end_time", pa.string()),
        ("duration_seconds", pa.float64()),
        *((name, pa.int64()) for name in COUNTS),
        ("error_message", pa.string()),
    ]
)


def _append(spark: SparkSession, spec: dict, df: DataFrame, table: str) -> None:
    database = spec["audit_database"]
    folder = f"{spec['managed_base']}/{database}"
    store.ensure_database(spark, f"{spec['catalog']}.{database}", folder)
    store.append(spark, df, f"{spec['catalog']}.{database}.{table}", f"{folder}/{table}")


def run_frame(spark: SparkSession, pipeline: str, meta: dict) -> DataFrame:
    """The run-log row; counts a run did not reach stay null."""
    start, end = meta.get("start_time"), meta.get("end_time")
    row = (
        pipeline,
        meta.get("status", "UNKNOWN"),
        str(start or ""),
        str(end or ""),
        (end - start).total_seconds() if start and end else None,
        *(meta.get(c) for c in COUNTS),
        meta.get("error_message"),
    )
    return few_rows(spark, [row], RUN_SCHEMA)


def log_run(spark: SparkSession, spec: dict, meta: dict) -> None:
    _append(spark, spec, run_frame(spark, spec["pipeline_name"], meta), spec["audit_table"])


def log_results(spark: SparkSession, spec: dict, results: list[quality.Result]) -> None:
    if results:
        rows = quality.result_frame(spark, spec["pipeline_name"], results)
        _append(spark, spec, rows, spec["dq_table"])
