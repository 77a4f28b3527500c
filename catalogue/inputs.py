"""Inputs the queries derive from the test tables, by Spark and at full size."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder for the files and tables of one query call."""
    return f"{shared_dir(spark)}/terrace-{uuid4().hex}"


def settings(base: str) -> dict:
    """Shared pipeline settings: databases and folders of one query call."""
    return {
        "catalog": "spark_catalog",
        "source_base": f"{base}/source",
        "managed_base": f"{base}/managed",
        "audit_database": f"audit_{base[-32:]}",
        "audit_table": "pipeline_run_log",
        "dq_table": "dq_results",
    }


def prefix(base: str) -> str:
    return f"t{base[-32:]}_"


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.option("header", str(header).lower()).csv(path)
    return path


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is missing where it was P, and priority where it was 5-LOW."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"),
    )


def money(column: str) -> str:
    return f"cast(cast({column} as decimal(15, 2)) as string)"


def write_credit_sources(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The four credit-risk sources as CSV: clients, credits, collaterals, market."""
    clients = table(spark, sf_dir, "customer").selectExpr(
        "concat('CLT-', c_custkey) AS client_id",
        "c_name AS name",
        "lower(c_mktsegment) AS city",
        f"{money('c_acctbal')} AS annual_income_eur",
        "350 + c_custkey * 37 % 500 AS credit_score",
    )
    credits = table(spark, sf_dir, "orders").selectExpr(
        "concat('CRD-', o_orderkey) AS credit_id",
        "concat('CLT-', o_custkey) AS client_id",
        "lower(o_orderpriority) AS credit_type",
        f"{money('o_totalprice')} AS total_amount_eur",
        "cast(floor(o_totalprice / 10) AS string) AS balance_amount_eur",
        "CASE o_orderstatus WHEN 'F' THEN 'Defaulted' WHEN 'O' THEN 'Active' ELSE 'Closed' END AS status",
    )
    collaterals = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('COL-', l_orderkey, '-', l_linenumber) AS collateral_id",
        "concat('CRD-', l_orderkey) AS credit_id",
        "CASE l_returnflag WHEN 'R' THEN 'Stocks' WHEN 'A' THEN 'Home' ELSE 'Car' END AS collateral_type",
        "cast(l_quantity AS int) AS numbers",
        f"CASE WHEN l_returnflag <> 'R' THEN {money('l_extendedprice')} END AS valuation_eur",
        "CASE WHEN l_returnflag = 'R' THEN concat('MKT-', l_partkey) END AS stock_id",
    )
    market = table(spark, sf_dir, "part").selectExpr(
        "concat('MKT-', p_partkey) AS market_id",
        "p_name AS stock_name",
        "lower(p_type) AS ticker",
        f"{money('p_retailprice')} AS current_value_eur",
    )
    sources = {"clients": clients, "credits": credits, "collaterals": collaterals, "market": market}
    for name, df in sources.items():
        write_csv(df, f"{folder}/{name}.csv")
