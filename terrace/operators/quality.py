"""Not-null rules: all counts in one pass, samples of the failing rows in one more."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.session import few_rows

# Texts and the sample size of the result rows.
SAMPLE_SIZE = 5
NO_ID_TEXT = "no identifying column available"
MORE_TEXT = " ... and {} more"
RESULT_SCHEMA = pa.schema(
    [
        ("pipeline_name", pa.string()),
        ("rule", pa.string()),
        ("status", pa.string()),
        ("failed_rows", pa.int64()),
        ("failed_ids", pa.string()),
        ("action", pa.string()),
        ("checked_at", pa.string()),
    ]
)


@dataclass(frozen=True)
class Rule:
    column: str
    action: str = "drop_row"

    @property
    def name(self) -> str:
        return f"{self.column}_not_null"

    @property
    def drops(self) -> bool:
        return self.action == "drop_row"


@dataclass(frozen=True)
class Result:
    rule: str
    status: str
    failed_rows: int | None
    failed_ids: str | None
    action: str


def rules_of(spec: dict) -> list[Rule]:
    return [Rule(r["column"], r.get("action", "drop_row")) for r in spec.get("data_quality") or []]


def _known(rules: list[Rule], columns: list[str]) -> dict[int, Rule]:
    names = {c.lower() for c in columns}
    return {i: r for i, r in enumerate(rules) if r.column.lower() in names}


def failures(rules: list[Rule], columns: list[str]) -> dict[int, Column]:
    """Per rule (by position) the condition under which a row fails it.

    Rules apply one after the other: a row that an earlier dropping rule
    removes is not seen by later ones. Rules on unknown columns are left out.
    """
    conditions, kept = {}, []
    for i, rule in _known(rules, columns).items():
        conditions[i] = reduce(and_, kept, F.col(rule.column).isNull())
        if rule.drops:
            kept.append(F.col(rule.column).isNotNull())
    return conditions


def failure_counts(rules: list[Rule], columns: list[str], among: Column | None = None) -> list[Column]:
    """One counting aggregate per rule, for ``agg`` or ``observe``, over the rows ``among`` all where that is given."""
    found = failures(rules, columns).items()
    return [F.count_if(c if among is None else among & c).alias(f"rule_{i}") for i, c in found]


def drop_failing(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Remove the rows that fail a dropping rule."""
    for rule in _known(rules, df.columns).values():
        if rule.drops:
            df = df.where(F.col(rule.column).isNotNull())
    return df


def sample_ids(df: DataFrame, rules: list[Rule], failed: list[int], identify_by: str) -> DataFrame:
    """``(rule, ids)``: the first ids, in id order, of the rows failing each rule.

    The rank filter is applied within every task before the shuffle, so each
    task sends at most five ids per rule.
    """
    conditions = failures(rules, df.columns)
    hits = F.array_compact(F.array(*[F.when(conditions[i], F.lit(i)) for i in failed]))
    first = Window.partitionBy("rule").orderBy("id")
    text = F.concat(F.lit(f"{identify_by}="), F.coalesce(F.col("id").cast("string"), F.lit("None")))
    return (
        df.where(reduce(or_, [conditions[i] for i in failed]))
        .select(F.col(identify_by).alias("id"), F.explode(hits).alias("rule"))
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= SAMPLE_SIZE)
        .groupBy("rule")
        .agg(F.array_sort(F.collect_list(F.struct("n", text.alias("text")))).alias("ids"))
        .select("rule", F.array_join("ids.text", ", ").alias("ids"))
    )


def evaluate(
    df: DataFrame, rules: list[Rule], identify_by: str | None = None, counts: dict | None = None
) -> list[Result]:
    """Results of all rules, in rule order.

    ``counts`` are failure counts observed elsewhere, for instance while the
    frame was written; without them one aggregate computes all of them. Rows
    are read again only for the sample, and only if some rule failed. A rule on
    an unknown column ends as ``ERROR`` and counts neither way.
    """
    known = _known(rules, df.columns)
    if counts is None:
        counts = df.agg(*failure_counts(rules, df.columns)).first().asDict() if known else {}
    failed = [i for i in known if counts[f"rule_{i}"] > 0]
    samples = {}
    if failed and identify_by in df.columns:
        samples = {r.rule: r.ids for r in sample_ids(df, rules, failed, identify_by).collect()}

    results = []
    for i, rule in enumerate(rules):
        n = counts[f"rule_{i}"] if i in known else None
        ids = None
        if n:
            ids = samples.get(i, NO_ID_TEXT)
            if n > SAMPLE_SIZE:
                ids += MORE_TEXT.format(n - SAMPLE_SIZE)
        status = "ERROR" if n is None else "FAIL" if n else "PASS"
        results.append(Result(rule.name, status, n, ids, rule.action))
    return results


def run_checks(df: DataFrame, spec: dict, counts: dict | None = None) -> tuple[DataFrame, list[Result]]:
    """Check a frame against a spec's rules; returns the kept rows and the results."""
    rules = rules_of(spec)
    return drop_failing(df, rules), evaluate(df, rules, spec.get("identify_by"), counts)


UNFIT = "_unfit_"  # columns that mark values of the wrong type, see ``try_types``


def type_counts(types: dict[str, str]) -> list[Column]:
    """Per typed column an aggregate over the marks of ``try_types``, for ``agg`` or ``observe``."""
    return [F.count_if(F.col(f"{UNFIT}{i}")).alias(f"type_{i}") for i in range(len(types))]


def type_results(types: dict[str, str], counts: dict) -> list[Result]:
    """Per typed column a result with the number of values that became null, from the counts of a write."""
    found = [(f"{c}_is_{t}", counts[f"type_{i}"]) for i, (c, t) in enumerate(types.items())]
    return [Result(name, "FAIL" if n else "PASS", n, None, "set_null") for name, n in found]


def malformed_result(action: str, n: int) -> Result:
    """The result for lines that did not have the fields of their file."""
    return Result("source_well_formed", "FAIL" if n else "PASS", n, NO_ID_TEXT if n else None, action)


def summary(results: list[Result]) -> dict[str, int]:
    statuses = [r.status for r in results]
    return {"dq_passed": statuses.count("PASS"), "dq_failed": statuses.count("FAIL")}


def result_frame(spark: SparkSession, pipeline: str, results: list[Result]) -> DataFrame:
    """One audit row per rule."""
    checked_at = str(datetime.now(UTC).replace(tzinfo=None))
    rows = [
        (pipeline, r.rule, r.status, r.failed_rows, r.failed_ids, r.action, checked_at)
        for r in results
    ]
    return few_rows(spark, rows, RESULT_SCHEMA)
