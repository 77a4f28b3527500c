"""Runs: CSV to bronze to silver, and the gold build, each with an audit row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import suppress
from datetime import UTC, datetime
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from terrace.operators import quality, store
from terrace.operators.joins import left_join, once_per_match
from terrace.operators.transforms import AUDIT_COLUMNS, add_audit_columns, apply_transformations, try_types
from terrace.plans import audit
from terrace.plans.spec import load_spec
from terrace.sources import MALFORMED, read_source

Spec = dict | str | Path


def _place(spark: SparkSession, spec: dict, layer: str) -> tuple[str, str]:
    """Name and folder of a layer's table, with its database in place."""
    target = spec["targets"][layer]
    database = f"{spec['catalog']}.{target['database']}"
    folder = f"{spec['managed_base']}/{layer}"
    store.ensure_database(spark, database, folder)
    return f"{database}.{target['table']}", f"{folder}/{target['table']}"


def write_bronze(spark: SparkSession, spec: dict) -> dict:
    """Write the source to bronze; returns its row count, the rule failure counts and that of malformed lines.

    Bronze holds the projected source without duplicate rows. The source is
    read once: counting the rows and checking the rules ride on this write.
    """
    df = read_source(spark, spec)
    action = spec["source"].get("malformed")
    columns = [c for c in df.columns if c != MALFORMED or not action]
    bad = [F.count_if(F.col(MALFORMED)).alias(MALFORMED)] if action else []
    conditions = quality.failure_counts(quality.rules_of(spec), columns)
    if action == "drop_row":  # rules are checked on the rows that silver sees
        conditions = quality.failure_counts(quality.rules_of(spec), columns, ~F.col(MALFORMED))
    df = add_audit_columns(df, spec["pipeline_name"], "bronze")
    keep = [c for c in df.columns if c != MALFORMED or action != "report"]
    return store.overwrite(spark, df, *_place(spark, spec, "bronze"), [*conditions, *bad], keep)


def write_silver(spark: SparkSession, df, spec: dict) -> dict:
    """First load or upsert by the spec's merge key; returns the table's row count and what did not fit its types.

    Values of the wrong type are counted while the rows are written for the first time.
    """
    types = spec.get("types") or {}
    keep = [*df.columns, *AUDIT_COLUMNS] if types else None
    if types:
        df = try_types(df, types, quality.UNFIT)
    df = add_audit_columns(df, spec["pipeline_name"], "silver")
    target = spec["targets"]["silver"]
    joins = any("join_table" in step for step in spec.get("transformations") or [])
    return store.first_load_or_upsert(
        spark,
        df,
        *_place(spark, spec, "silver"),
        target.get("merge_key"),
        target.get("partition_by"),
        materialize=joins,
        metrics=quality.type_counts(types),
        keep=keep,
        buckets=target.get("buckets"),
    )


def make_views(spark: SparkSession, spec: dict) -> list[str]:
    """The frames that a gold table's text can name beside tables, as temporary views; returns their names.

    A view is SQL text (``sql``), or a join that is safe with hot keys where one of
    that text would not be: ``left_join`` or ``once_per_match`` of two tables or
    earlier views. In Python it may be a function of the session and the catalog.
    """
    made = []
    for name, what in (spec.get("views") or {}).items():
        if callable(what):
            df = what(spark, spec["catalog"])
        elif "sql" in what:
            df = spark.sql(what["sql"])
        elif "left_join" in what:
            how = what["left_join"]
            keys_of = how.get("keys_of")
            df = left_join(spark.table(how["left"]), spark.table(how["right"]), how["key"], keys_of and spark.table(keys_of))
        else:
            how = what["once_per_match"]
            df = once_per_match(spark.table(how["left"]), spark.table(how["right"]), how["left_key"], how["right_key"])
        df.createOrReplaceTempView(name)
        made.append(name)
    return made


def write_gold(spark: SparkSession, spec: dict) -> int:
    """Replace the gold table by the result of the spec's SQL; returns its row count.

    The SQL may name ``views`` of the spec. Instead of ``gold_sql`` a spec can give
    ``gold_frame``, a function of the session and the catalog name that returns
    the frame to write. ``order_by`` of the target sorts the table's rows.
    """
    if not {"gold_sql", "gold_frame"} & set(spec) or "gold" not in spec.get("targets", {}):
        return 0
    views = make_views(spark, spec)
    try:
        if "gold_frame" in spec:
            df = spec["gold_frame"](spark, spec["catalog"])
        else:
            df = spark.sql(spec["gold_sql"])
        df = add_audit_columns(df, spec["pipeline_name"], "gold")
        order = spec["targets"]["gold"].get("order_by")
        return store.overwrite(spark, df, *_place(spark, spec, "gold"), order_by=order)["rows"]
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def _to_silver(spark: SparkSession, spec: dict, meta: dict) -> None:
    observed = write_bronze(spark, spec)
    meta["source_count"] = meta["bronze_count"] = observed["rows"]

    bronze = spark.table(_place(spark, spec, "bronze")[0]).drop(*AUDIT_COLUMNS)
    action = spec["source"].get("malformed")
    if action == "drop_row":
        bronze = bronze.where(f"NOT {MALFORMED}").drop(MALFORMED)
    clean, results = quality.run_checks(bronze, spec, observed)
    if action:
        results = [quality.malformed_result(action, observed[MALFORMED]), *results]
    audit.log_results(spark, spec, results)
    meta |= quality.summary(results)

    silver = apply_transformations(spark, clean, spec)
    written = write_silver(spark, silver, spec)
    meta["silver_count"] = written["rows"]
    if types := spec.get("types"):
        fits = quality.type_results(types, written)
        audit.log_results(spark, spec, fits)
        meta |= quality.summary(results + fits)


def _to_gold(spark: SparkSession, spec: dict, meta: dict) -> None:
    meta["gold_count"] = write_gold(spark, spec)


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _run(work: Callable, spec: Spec, settings: Spec | None, spark: SparkSession | None) -> dict:
    spark = spark or SparkSession.builder.getOrCreate()
    spec = load_spec(spec, settings)
    meta = {"start_time": _utc_now()}
    try:
        work(spark, spec, meta)
    except Exception as e:
        meta |= {"status": "FAILED", "end_time": _utc_now(), "error_message": str(e)}
        try:
            audit.log_run(spark, spec, meta)
        except Exception:
            pass  # the error of the run itself is the one to report
        raise
    meta |= {"status": "SUCCESS", "end_time": _utc_now()}
    audit.log_run(spark, spec, meta)
    return meta


def run_pipeline(spec: Spec, settings: Spec | None = None, spark: SparkSession | None = None) -> dict:
    """Run one table from CSV to silver; returns the facts of the run log."""
    return _run(_to_silver, spec, settings, spark)


def run_gold(spec: Spec, settings: Spec | None = None, spark: SparkSession | None = None) -> dict:
    """Build one gold table from silver; returns the facts of the run log."""
    return _run(_to_gold, spec, settings, spark)


def _silver_name(spec: dict) -> str | None:
    """The silver table that a spec writes."""
    target = (spec.get("targets") or {}).get("silver")
    return f"{spec['catalog']}.{target['database']}.{target['table']}".lower() if target and "source" in spec else None


def _texts(part) -> Iterator[str]:
    """All texts of a spec, and a mark for functions, which may read anything."""
    if isinstance(part, dict):
        for value in part.values():
            yield from _texts(value)
    elif isinstance(part, list):
        for value in part:
            yield from _texts(value)
    elif callable(part):
        yield ANY
    elif isinstance(part, str):
        yield part.lower()


ANY = "*"


def needs(specs: list[dict]) -> list[set[int]]:
    """For each spec the earlier ones that must be done before it starts.

    That is whoever writes a table that the spec reads or writes itself, or reads a
    table that the spec writes. Tables are found by their names in lookups, views
    and the gold text; a spec with functions needs all earlier ones.
    """
    reads = [
        set(_texts([[t.get("join_table") for t in s.get("transformations") or []], s.get("gold_sql"), s.get("views"), s.get("gold_frame")]))
        for s in specs
    ]
    silver = [_silver_name(s) for s in specs]
    targets = [
        {(layer, t.get("database"), t.get("table")) for layer, t in (s.get("targets") or {}).items()} for s in specs
    ]

    def uses(texts: set[str], table: str | None) -> bool:
        short = table and table.split(".", 1)[1]
        return ANY in texts or bool(table) and any(short in x for x in texts)

    return [
        {
            j
            for j in range(i)
            if uses(reads[i], silver[j]) or uses(reads[j], silver[i]) or targets[i] & targets[j]
        }
        for i in range(len(specs))
    ]


def _written_tables(spec: dict) -> list[str]:
    """All tables that a run of a spec may write."""
    targets = [f"{t['database']}.{t['table']}" for t in (spec.get("targets") or {}).values()]
    audits = [f"{spec['audit_database']}.{spec[t]}" for t in ("audit_table", "dq_table")]
    return [f"{spec['catalog']}.{name}" for name in targets + audits]


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, in which writes need not take turns with another's."""
    new = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if new.conf.isModifiable(name) and new.conf.get(name, None) != value:
            new.conf.set(name, value)
    return new


def run_all(
    specs: list[Spec], settings: Spec | None = None, spark: SparkSession | None = None, at_once: int = 4
) -> list[dict]:
    """Run specs: those with a source to silver, the others to gold; results are in list order.

    A spec starts when the earlier specs that it needs (``needs``) are done, so up to
    ``at_once`` run at the same time, each in a session of its own; temporary
    views of the caller's session are not seen there. After a failure no further
    spec starts, and the first error in list order is raised once all have ended.
    """
    spark = spark or SparkSession.builder.getOrCreate()
    loaded = [load_spec(s, settings) for s in specs]
    before = needs(loaded)

    def run(i: int) -> dict:
        own = spark if at_once == 1 else _own_session(spark)
        return run_pipeline(loaded[i], spark=own) if "source" in loaded[i] else run_gold(loaded[i], spark=own)

    done: dict[int, dict] = {}
    errors: dict[int, BaseException] = {}
    running: dict[Future, int] = {}
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        while len(done) < len(loaded):
            if not errors:
                for i in range(len(loaded)):
                    if i not in done and i not in running.values() and before[i] <= done.keys():
                        running[pool.submit(run, i)] = i
            if not running:
                break
            for ended in wait(running, return_when=FIRST_COMPLETED).done:
                i = running.pop(ended)
                if error := ended.exception():
                    errors[i] = error
                else:
                    done[i] = ended.result()
    for name in {x for s in loaded for x in _written_tables(s)}:
        with suppress(AnalysisException):  # this session may remember where the table was; or there is none
            spark.catalog.refreshTable(name)
    if errors:
        raise errors[min(errors)]
    return [done[i] for i in range(len(loaded))]
