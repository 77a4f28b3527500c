"""The queries. Each takes ``(spark, sf_dir)`` and runs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.inputs import (
    orders_with_gaps,
    prefix,
    settings,
    table,
    work_folder,
    write_credit_sources,
    write_csv,
)
from terrace import run_all, run_gold, run_pipeline, table_spec
from terrace.functions import coverage_flag, or_zero, risk_band
from terrace.operators import quality, store
from terrace.operators.joins import left_join, once_per_match
from terrace.operators.transforms import (
    add_audit_columns,
    apply_transformations,
    cast_double,
    enrich,
    uppercase,
)
from terrace.plans import audit
from terrace.plans.credit_risk import (
    credit_risk_fact,
    credit_risk_specs,
    gold_sql_spec,
    ordered_by_risk,
)
from terrace.session import written_sized
from terrace.sources import read_csv, read_source

VALUATION = (
    "CASE WHEN l_returnflag = 'R' THEN l_quantity * p_retailprice ELSE l_extendedprice END"
)


# --- sources -----------------------------------------------------------------


def csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ids = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return read_csv(spark, write_csv(ids, f"{work_folder(spark)}/orders.csv"))


def csv_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = write_csv(customer, f"{work_folder(spark)}/customer.csv", header=False)
    return read_csv(spark, path, ["id", "name", "nation"], has_header=False)


def source_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").drop("c_acctbal")
    path = write_csv(customer, f"{work_folder(spark)}/customer.csv")
    return read_csv(spark, path, ["c_name", "c_custkey"])


def source_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    path = write_csv(lines, f"{work_folder(spark)}/lineitem.csv")
    return read_source(spark, {"source": {"path": path, "columns": ["l_orderkey", "l_linenumber"]}})


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count observed while lineitem is written, next to a count of the table."""
    base = work_folder(spark)
    database = f"{prefix(base)}counts"
    store.ensure_database(spark, database, base)
    name = f"{database}.lineitem"
    seen = store.overwrite(spark, table(spark, sf_dir, "lineitem"), name, f"{base}/lineitem")
    return spark.table(name).agg(
        F.lit(seen["rows"]).cast("bigint").alias("n_written"), F.count(F.lit(1)).alias("n_read")
    )


# --- projections and transformations ------------------------------------------


def upper_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return uppercase(part, "p_name", "p_type")


def cast_double_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey AS string) AS o_custkey"
    )
    return cast_double(text, ["O_CUSTKEY"])


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    stamped = add_audit_columns(customer, "customer_run", "silver")
    return stamped.withColumn("_loaded_at", F.col("_loaded_at").isNotNull())


def left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return enrich(
        lines,
        table(spark, sf_dir, "part"),
        "l_extendedprice",
        "line.l_partkey = part.p_partkey",
        VALUATION,
        left_alias="line",
        right_alias="part",
        numeric=["l_quantity", "l_extendedprice", "p_retailprice"],
    )


def drop_joined_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup shares a column name with the rows it enriches."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_returnflag").alias("label")
    )
    lookup = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("label"))
    return enrich(
        lines,
        lookup,
        "part_label",
        "line.l_partkey = part.p_partkey",
        "concat(line.label, ':', part.label)",
        left_alias="line",
        right_alias="part",
        numeric=[],
    )


def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment tests an upper-case category, so it relies on the step before."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "lower(l_returnflag) AS collateral_type",
        "cast(cast(l_quantity AS int) AS string) AS numbers",
        "cast(l_suppkey AS string) AS valuation_eur",
        "l_partkey AS stock_id",
    )
    prices = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS market_id", "cast(p_size AS string) AS current_value_eur"
    )
    view = prefix(work_folder(spark)) + "market"
    prices.createOrReplaceTempView(view)
    steps = [
        {"action": "uppercase", "column": "collateral_type"},
        {
            "action": "stock_enrichment",
            "column": "valuation_eur",
            "join_table": view,
            "join_on": "collaterals.stock_id = market.market_id",
            "expression": "CASE WHEN collateral_type = 'R' THEN numbers * current_value_eur "
            "ELSE valuation_eur END",
        },
    ]
    chain = apply_transformations(spark, lines, {"transformations": steps})
    spark.catalog.dropTempView(view)  # the frame has read it
    return chain


def string_number_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "cast(c_custkey AS string) AS score", f"c_acctbal >= cast(c_nationkey AS string) AS ge"
    )
    return text.select("c_custkey", (F.col("score") < 500).alias("lt"), "ge")


def case_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber", "l_extendedprice"
    )
    value = F.col("l_extendedprice")
    cases = left_join(orders, lines, "o_orderkey").select(
        "o_orderkey",
        or_zero(F.col("l_linenumber")).alias("line"),
        or_zero(value).alias("value"),
        coverage_flag(value, F.col("o_totalprice")).alias("covered"),
        risk_band(F.col("o_orderstatus") == "F", F.col("l_linenumber"), 3, 5).alias("band"),
    )
    return written_sized(cases, f"{work_folder(spark)}/cases")


# --- joins and facts ----------------------------------------------------------


def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return customer.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", "o_orderstatus"
    )


def left_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )
    joined = left_join(orders, lines, "o_orderkey")
    return written_sized(joined, f"{work_folder(spark)}/joined")


def unused_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup adds no column, but every line must still come out once per match."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return once_per_match(lines, part, "l_partkey", "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


def unused_left_join_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a lookup that has some keys several times and others not at all."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return once_per_match(orders, lines, "o_orderkey", "l_orderkey")


def _risk_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as clients, orders as credits, line items as collaterals, parts as market."""
    clients = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS client_id", "c_name AS name", "c_mktsegment AS city", "c_acctbal AS credit_score"
    )
    credits = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS credit_id",
        "o_custkey AS client_id",
        "o_orderpriority AS credit_type",
        "o_totalprice AS total_amount_eur",
        "o_totalprice AS balance_amount_eur",
        "o_orderstatus AS status",
    )
    collaterals = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS credit_id",
        "l_returnflag AS collateral_type",
        "l_quantity AS numbers",
        "l_extendedprice AS valuation_eur",
        "l_partkey AS stock_id",
    )
    market = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS market_id", "p_retailprice AS current_value_eur"
    )
    valued = enrich(
        collaterals,
        market,
        "valuation_eur",
        "collaterals.stock_id = market.market_id",
        "CASE WHEN collateral_type = 'R' THEN numbers * current_value_eur ELSE valuation_eur END",
    )
    return credit_risk_fact(clients, credits, valued, collaterals, "F", 500, 7000)


def gold_risk_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_sized(_risk_fact(spark, sf_dir), f"{work_folder(spark)}/fact")


def ordered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_by_risk(gold_risk_fact(spark, sf_dir))


# --- data quality -------------------------------------------------------------


def _results(spark: SparkSession, df: DataFrame, rules: list[dict], identify_by: str | None):
    spec = {"data_quality": rules, "identify_by": identify_by}
    return quality.run_checks(df, spec)[1]


def _result_rows(spark: SparkSession, df: DataFrame, rules: list[dict], identify_by=None) -> DataFrame:
    results = _results(spark, df, rules, identify_by)
    return quality.result_frame(spark, "orders_run", results).drop("pipeline_name", "checked_at")


def not_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"column": "o_orderstatus", "check": "not_null"}, {"column": "o_orderkey"}]
    return _result_rows(spark, orders_with_gaps(spark, sf_dir), rules)


def not_null_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"column": "o_orderstatus", "action": "drop_row"},
        {"column": "o_orderpriority", "action": "report"},
        {"column": "o_orderpriority", "action": "drop_row"},
        {"column": "o_orderpriority", "action": "drop_row"},
    ]
    return _result_rows(spark, orders_with_gaps(spark, sf_dir), rules)


def failed_id_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"column": "o_orderstatus"}, {"column": "o_orderpriority"}]
    return _result_rows(spark, orders_with_gaps(spark, sf_dir), rules, "o_orderkey")


def dq_unknown_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"column": "no_such_column"}, {"column": "o_orderstatus"}]
    return _result_rows(spark, orders_with_gaps(spark, sf_dir), rules)


def not_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.rules_of({"data_quality": [{"column": "o_orderstatus"}]})
    return quality.drop_failing(orders_with_gaps(spark, sf_dir), rules)


def not_null_report_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"column": "o_orderstatus", "action": "report"}]
    return quality.drop_failing(
        orders_with_gaps(spark, sf_dir), quality.rules_of({"data_quality": rules})
    )


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"column": c} for c in ("o_orderstatus", "o_orderkey", "o_custkey", "no_such_column")]
    counts = quality.summary(_results(spark, orders_with_gaps(spark, sf_dir), rules, None))
    return spark.createDataFrame([counts], "dq_passed bigint, dq_failed bigint")


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of two runs, appended to the audit table and read back."""
    base = work_folder(spark)
    spec = settings(base) | {"pipeline_name": "orders_run"}
    for column in ("o_orderstatus", "o_orderkey"):
        found = _results(spark, orders_with_gaps(spark, sf_dir), [{"column": column}], "o_custkey")
        audit.log_results(spark, spec, found)
    name = f"{spec['catalog']}.{spec['audit_database']}.{spec['dq_table']}"
    return spark.table(name).withColumn("checked_at", F.col("checked_at").isNotNull())


# --- tables -------------------------------------------------------------------


def _new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    base = work_folder(spark)
    database = f"{prefix(base)}store"
    store.ensure_database(spark, database, base)
    return f"{database}.{name}", f"{base}/{name}"


def overwrite_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _new_table(spark, "target")
    for source in ("orders", "customer"):
        store.overwrite(spark, table(spark, sf_dir, source), name, path)
    return spark.table(name)


def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _new_table(spark, "parties")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_nationkey AS nation", "s_name AS name"
    )
    for df in (customers, suppliers, customers):
        store.append(spark, df, name, path)
    return spark.table(name)


def silver_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = _new_table(spark, "orders")
    store.first_load_or_upsert(spark, table(spark, sf_dir, "orders"), name, path, "o_orderkey")
    return spark.table(name)


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def _changed_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders under keys shifted by 500, with a new status and double the price."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice * 2 AS o_totalprice",
        "o_orderkey + 500 AS o_orderkey",
        "nullif(o_orderstatus, 'P') AS o_orderstatus",
        "o_custkey AS not_in_target",
    )


def _upserted(spark: SparkSession, target: DataFrame, key: str, *sources: DataFrame) -> DataFrame:
    name, path = _new_table(spark, "target")
    for df in (target, *sources):
        store.first_load_or_upsert(spark, df, name, path, key)
    return spark.table(name)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _changed_balances(spark, sf_dir)
    return _upserted(spark, _balances(spark, sf_dir), "o_orderkey", changed)


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _changed_balances(spark, sf_dir)
    return _upserted(spark, _balances(spark, sf_dir), "o_orderkey", changed, changed)


def upsert_repeated_target_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load has several rows per key; a match updates all of them."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS k", "l_returnflag AS flag", "l_linenumber AS n"
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey * 2 AS k", "o_orderstatus AS flag", "0 AS n"
    )
    return _upserted(spark, lines, "k", orders)


def upsert_unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys and repeated keys that match nothing are all inserted."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_orderstatus AS flag")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_returnflag <> 'R' THEN -1 - l_orderkey END AS k", "l_linestatus AS flag"
    )
    return _upserted(spark, orders, "k", lines)


def upsert_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day in 16 partitions; the second load has the last day alone, a new key many times, and null keys."""
    name, path = _new_table(spark, "target")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(cast(o_orderdate AS date) AS string) AS day", "o_orderkey", "o_orderpriority AS note"
    )
    store.first_load_or_upsert(spark, orders, name, path, "day", partition_by=16)
    last = orders.groupBy().agg(F.max("day").alias("day")).selectExpr("day", "-1L AS o_orderkey", "'closed' AS note")
    unknown = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").selectExpr(
        "if(o_orderpriority = '1-URGENT', NULL, 'no day') AS day", "o_orderkey", "'open' AS note"
    )
    store.first_load_or_upsert(spark, last.union(unknown), name, path, "day")
    return spark.table(name).drop(store.PART)


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in 8 buckets by its key, loaded twice more without being shuffled."""
    name, path = _new_table(spark, "target")
    store.first_load_or_upsert(spark, _balances(spark, sf_dir), name, path, "o_orderkey", buckets=8)
    for _ in range(2):
        store.first_load_or_upsert(spark, _changed_balances(spark, sf_dir), name, path, "o_orderkey")
    return spark.table(name)


def append_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six appends to a table that holds three folders at most, and the number of its files against that."""
    name, path = _new_table(spark, "parties")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name").coalesce(1)
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS nation").coalesce(1)
    for df in (customers, suppliers) * 3:
        store.append(spark, df, name, path, most=3)
    files = F.input_file_name()
    rows = spark.table(name)
    few = rows.select(files.alias("f")).distinct().count() <= 3
    return rows.withColumn("few_files", F.lit(few))


# --- runs ---------------------------------------------------------------------


def _customer_spec(base: str) -> dict:
    spec = table_spec(
        "customer_run",
        "customer",
        "c_custkey",
        "c_name",
        ["c_custkey", "c_name", "c_nationkey", "segment"],
        uppercase=["segment"],
        dq_rules=[{"column": "c_custkey"}, {"column": "segment", "action": "report"}],
        prefix=prefix(base),
    )
    return settings(base) | spec


def _customers(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Customers, some without a key or segment, under shifted keys."""
    return table(spark, sf_dir, "customer").selectExpr(
        f"CASE WHEN c_nationkey <> 3 THEN c_custkey + {shift} END AS c_custkey",
        "c_name",
        "c_nationkey",
        "nullif(lower(c_mktsegment), 'furniture') AS segment",
    )


def _run_customers(spark: SparkSession, sf_dir: str, base: str | None = None, shift: int = 0) -> dict:
    """Run a CSV of customers to silver; returns the spec."""
    base = base or work_folder(spark)
    spec = _customer_spec(base) | {"source_base": f"{base}/source-{shift}"}
    write_csv(_customers(spark, sf_dir, shift), f"{base}/source-{shift}/customer.csv")
    run_pipeline(spec, spark=spark)
    return spec


def csv_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _run_customers(spark, sf_dir)
    name = f"{spec['targets']['silver']['database']}.customer"
    return spark.table(name).drop("_loaded_at")


def silver_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run whose source has the customers under keys shifted by 100."""
    base = work_folder(spark)
    for shift in (0, 100):
        spec = _run_customers(spark, sf_dir, base, shift)
    name = f"{spec['targets']['silver']['database']}.customer"
    return spark.table(name).drop("_loaded_at")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _run_customers(spark, sf_dir)
    log = spark.table(f"{spec['audit_database']}.{spec['audit_table']}")
    timed = (F.col("duration_seconds") > 0) & (F.col("start_time") < F.col("end_time"))
    return log.withColumn("timed", timed).drop("start_time", "end_time", "duration_seconds")


def failed_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log row of a run that stops at an unknown transformation."""
    base = work_folder(spark)
    spec = _customer_spec(base)
    spec["transformations"].append({"column": "c_name", "action": "lowercase"})
    write_csv(_customers(spark, sf_dir), f"{base}/source/customer.csv")
    try:
        run_pipeline(spec, spark=spark)
    except ValueError:
        pass
    log = spark.table(f"{spec['audit_database']}.{spec['audit_table']}")
    return log.drop("start_time", "end_time", "duration_seconds")


def credit_risk_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five specs from CSV files to the gold fact."""
    base = work_folder(spark)
    write_credit_sources(spark, sf_dir, f"{base}/source")
    run_all(credit_risk_specs(prefix(base)), settings(base), spark)
    return spark.table(f"{prefix(base)}gold.credit_risk_fact").drop("_loaded_at")


def gold_sql_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold fact from SQL text over the four silver tables."""
    base = work_folder(spark)
    write_credit_sources(spark, sf_dir, f"{base}/source")
    specs = credit_risk_specs(prefix(base))[:4] + [gold_sql_spec(prefix(base))]
    run_all(specs, settings(base), spark)
    return spark.table(f"{prefix(base)}gold.credit_risk_fact").drop("_loaded_at")


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too many or too few do not reach silver; the rule results count them."""
    base = work_folder(spark)
    line = """concat(o_orderkey, ',', o_orderstatus, CASE o_orderpriority WHEN '5-LOW' THEN '' ELSE concat(',', o_orderpriority) END,
              CASE o_orderpriority WHEN '1-URGENT' THEN ',now' ELSE '' END)"""
    table(spark, sf_dir, "orders").selectExpr(f"{line} AS line").write.text(f"{base}/source/orders.csv")
    spec = settings(base) | table_spec("orders_run", "orders", "id", "status", ["id", "status", "priority"], prefix=prefix(base))
    spec["source"] |= {"has_header": False, "malformed": "drop_row"}
    run_pipeline(spec, spark=spark)
    results = spark.table(f"{spec['audit_database']}.{spec['dq_table']}")
    bad = results.where("rule = 'source_well_formed'").first()
    silver = spark.table(f"{spec['targets']['silver']['database']}.orders").select("id", "status", "priority")
    return silver.withColumns({"bad_status": F.lit(bad.status), "bad_lines": F.lit(bad.failed_rows).cast("bigint")})


def gold_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table sorted by band over its files: each row with the least band of its file, and how files overlap."""
    name, path = _new_table(spark, "fact")
    fact = _risk_fact(spark, sf_dir)
    order = ["overall_risk", "client_id", "credit_id", "collateral_value_eur"]
    store.overwrite(spark, fact, name, path, order_by=order)
    rows = spark.table(name).withColumn("_file", F.input_file_name())
    ends = rows.groupBy("_file").agg(F.min("overall_risk").alias("low"), F.max("overall_risk").alias("high"))
    a, b = ends.alias("a"), ends.alias("b")
    mixed = a.join(b, (F.col("a.low") < F.col("b.low")) & (F.col("a.high") > F.col("b.low"))).count()
    return rows.drop("_file").withColumn("overlaps", F.lit(mixed).cast("bigint"))


def typed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed silver columns; values that do not fit become null and are counted in the rule results."""
    base = work_folder(spark)
    spec = _customer_spec(base) | {"types": {"c_custkey": "bigint", "C_NATIONKEY": "int", "segment": "double"}}
    spec["data_quality"] = []
    write_csv(_customers(spark, sf_dir), f"{base}/source/customer.csv")
    run_pipeline(spec, spark=spark)
    bad = spark.table(f"{spec['audit_database']}.{spec['dq_table']}").where("status = 'FAIL'").first()
    silver = spark.table(f"{spec['targets']['silver']['database']}.customer").drop("_loaded_at", "_layer", "_pipeline")
    return silver.withColumns({"bad_rule": F.lit(bad.rule), "bad_rows": F.lit(bad.failed_rows).cast("bigint")})


def gold_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table from SQL text over two silver tables."""
    base = work_folder(spark)
    silver, folder = f"{prefix(base)}silver", f"{base}/managed/silver"
    store.ensure_database(spark, silver, folder)
    for name in ("orders", "lineitem"):
        store.overwrite(spark, table(spark, sf_dir, name), f"{silver}.{name}", f"{folder}/{name}")
    spec = settings(base) | {
        "pipeline_name": "gold_text",
        "targets": {"gold": {"database": f"{prefix(base)}gold", "table": "order_lines"}},
        "gold_sql": f"""
            SELECT o.o_orderkey AS order_key, upper(l.l_linestatus) AS line_status,
                   COALESCE(l.l_extendedprice, 0) AS value,
                   CASE WHEN l.l_extendedprice >= o.o_totalprice THEN 'YES' ELSE 'NO' END AS covers
            FROM {{catalog}}.{silver}.orders o
            LEFT JOIN {{catalog}}.{silver}.lineitem l ON o.o_orderkey = l.l_orderkey""",
    }
    run_gold(spec, spark=spark)
    return spark.table(f"{prefix(base)}gold.order_lines").drop("_loaded_at")


QUERIES = {
    f.__name__.removesuffix("_query"): f
    for f in (
        gold_risk_fact,
        csv_string_scan,
        csv_without_header,
        source_projection,
        source_dedup,
        row_count,
        upper_columns,
        cast_double_query,
        audit_columns,
        left_enrich,
        drop_joined_columns,
        transform_chain,
        string_number_compare,
        case_coalesce,
        inner_join,
        left_outer_join,
        unused_left_join,
        unused_left_join_repeats,
        ordered_fact,
        not_null_report,
        not_null_sequential,
        failed_id_sample,
        dq_unknown_column,
        not_null_drop,
        not_null_report_only,
        dq_summary,
        dq_results,
        overwrite_replace,
        append_evolve,
        silver_first_load,
        upsert_merge,
        upsert_idempotent,
        upsert_repeated_target_keys,
        upsert_unmatched_keys,
        upsert_touched_partitions,
        upsert_bucketed,
        append_compacted,
        csv_malformed,
        gold_sorted,
        csv_to_silver,
        silver_reload,
        run_log,
        failed_run_log,
        credit_risk_run,
        gold_sql_text,
        gold_sql_fact,
        typed_silver,
    )
}
