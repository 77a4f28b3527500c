"""The credit-risk tables: four sources, and the fact built from them."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import coverage_flag, or_zero, risk_band
from terrace.operators.joins import left_join, once_per_match
from terrace.plans.spec import table_spec

# The status and score limits of the risk bands, and below the columns of the
# tables, the lookup condition and the valuation.
DEFAULTED = "DEFAULTED"
HIGH_BELOW = 500
MEDIUM_BELOW = 700


def credit_risk_specs(prefix: str = "") -> list[dict]:
    """Specs of the four tables and the gold fact, in run order.

    Collaterals look up market prices, so market comes first. ``prefix`` goes
    before the database names.
    """
    silver = f"{{catalog}}.{prefix}silver"
    market = table_spec(
        "market_pipeline",
        "market",
        "market_id",
        "ticker",
        ["market_id", "stock_name", "ticker", "current_value_eur"],
        uppercase=["ticker", "stock_name"],
        prefix=prefix,
    )
    clients = table_spec(
        "clients_pipeline",
        "clients",
        "client_id",
        "name",
        ["client_id", "name", "city", "annual_income_eur", "credit_score"],
        uppercase=["city"],
        prefix=prefix,
    )
    credits = table_spec(
        "credits_pipeline",
        "credits",
        "credit_id",
        "client_id",
        [
            "credit_id",
            "client_id",
            "credit_type",
            "total_amount_eur",
            "balance_amount_eur",
            "status",
        ],
        uppercase=["status", "credit_type"],
        prefix=prefix,
    )
    collaterals = table_spec(
        "collaterals_pipeline",
        "collaterals",
        "collateral_id",
        "credit_id",
        ["collateral_id", "credit_id", "collateral_type", "numbers", "valuation_eur", "stock_id"],
        uppercase=["collateral_type"],
        transformations=[
            {
                "column": "valuation_eur",
                "action": "stock_enrichment",
                "join_table": f"{silver}.market",
                "join_on": "collaterals.stock_id = market.market_id",
                "expression": (
                    "CASE WHEN collateral_type = 'STOCKS' THEN numbers * current_value_eur "
                    "ELSE valuation_eur END"
                ),
            }
        ],
        prefix=prefix,
    )
    gold = {
        "pipeline_name": "gold_pipeline",
        "targets": {"gold": {"database": f"{prefix}gold", "table": "credit_risk_fact"}},
        "gold_frame": partial(fact_of_silver, silver=silver),
    }
    return [market, clients, credits, collaterals, gold]


def gold_sql_spec(prefix: str = "") -> dict:
    """The gold fact as SQL text over the silver tables and three views, a spec that fits into YAML.

    The outer join is a view, so that it can be split at a hot key. A collateral
    counts once per market row that it matches.
    """
    silver = f"{{catalog}}.{prefix}silver"
    return {
        "pipeline_name": "gold_pipeline",
        "targets": {"gold": {"database": f"{prefix}gold", "table": "credit_risk_fact"}},
        "views": {
            "exposure": {"sql": f"SELECT * FROM {silver}.clients JOIN {silver}.credits USING (client_id)"},
            "counted": {
                "once_per_match": {
                    "left": f"{silver}.collaterals",
                    "right": f"{silver}.market",
                    "left_key": "stock_id",
                    "right_key": "market_id",
                }
            },
            "pledge": {"sql": "SELECT credit_id, collateral_type, valuation_eur FROM counted"},
            "pledged": {
                "left_join": {
                    "left": "exposure",
                    "right": "pledge",
                    "key": "credit_id",
                    "keys_of": f"{silver}.collaterals",
                }
            },
        },
        "gold_sql": f"""
            SELECT client_id, name, city, credit_id, credit_type, total_amount_eur, balance_amount_eur,
                   status AS credit_status, collateral_type,
                   COALESCE(valuation_eur, 0) AS collateral_value_eur,
                   IF(COALESCE(valuation_eur, 0) >= balance_amount_eur, 'YES', 'NO') AS is_covered,
                   CASE WHEN status = '{DEFAULTED}' OR credit_score < {HIGH_BELOW} THEN 'HIGH'
                        WHEN credit_score < {MEDIUM_BELOW} THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk
            FROM pledged""",
    }


def fact_of_silver(spark: SparkSession, catalog: str, silver: str) -> DataFrame:
    """The fact over the silver tables.

    Market adds no column, but a collateral counts once per market row it matches.
    """
    silver = silver.replace("{catalog}", catalog)
    clients, credits, collaterals, market = (
        spark.table(f"{silver}.{t}") for t in ("clients", "credits", "collaterals", "market")
    )
    pledges = once_per_match(collaterals, market, "stock_id", "market_id")
    return credit_risk_fact(clients, credits, pledges, keys_of=collaterals)


def credit_risk_fact(
    clients: DataFrame,
    credits: DataFrame,
    pledges: DataFrame,
    keys_of: DataFrame | None = None,
    defaulted: str = DEFAULTED,
    high_below: int = HIGH_BELOW,
    medium_below: int = MEDIUM_BELOW,
) -> DataFrame:
    """One row per credit and collateral, and one for a credit without any.

    Each collateral is tested for coverage alone. ``keys_of`` is a frame with the
    credit ids of ``pledges`` that is cheaper to read.
    """
    band = risk_band(
        F.col("status") == defaulted, F.col("credit_score"), high_below, medium_below
    )
    exposure = clients.join(credits, "client_id").select(
        "client_id",
        "name",
        "city",
        "credit_id",
        "credit_type",
        "total_amount_eur",
        "balance_amount_eur",
        F.col("status").alias("credit_status"),
        band.alias("overall_risk"),
    )
    pledged = pledges.select("credit_id", "collateral_type", "valuation_eur")
    value, balance = F.col("valuation_eur"), F.col("balance_amount_eur")
    return left_join(exposure, pledged, "credit_id", keys_of).select(
        "client_id",
        "name",
        "city",
        "credit_id",
        "credit_type",
        "total_amount_eur",
        "balance_amount_eur",
        "credit_status",
        "collateral_type",
        or_zero(value).alias("collateral_value_eur"),
        coverage_flag(value, balance).alias("is_covered"),
        "overall_risk",
    )


def ordered_by_risk(fact: DataFrame) -> DataFrame:
    """The fact sorted by risk band.

    The band has three values, and rows with equal sort keys cannot be spread
    over several sort tasks; the other columns break the ties. A fact that is
    costly to compute should be a table first (``written``), as finding the ranges reads it once more.
    """
    rest = [c for c in ("client_id", "credit_id", "collateral_value_eur") if c in fact.columns]
    return fact.orderBy("overall_risk", *rest)
