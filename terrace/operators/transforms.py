"""Ordered column transformations and the lookup-join enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Aliases and numeric columns an enrichment step uses unless it names its own.
LEFT_ALIAS = "collaterals"
RIGHT_ALIAS = "market"
NUMERIC_COLUMNS = ["numbers", "current_value_eur", "valuation_eur"]


def uppercase(df: DataFrame, *columns: str) -> DataFrame:
    """Uppercase columns in place; null stays null."""
    return df.withColumns({c: F.upper(c) for c in columns})


def _named(df: DataFrame, columns: list[str]) -> list[str]:
    """The frame's own spelling of some columns; a name it does not have is an error."""
    own = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in own]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return [own[c.lower()] for c in columns]


def cast_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast ``columns`` to double, in place. Names compare without case, as in Spark."""
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in _named(df, columns)})


def try_types(df: DataFrame, types: dict[str, str], unfit: str | None = None) -> DataFrame:
    """Give columns their types, in place; a value that does not fit becomes null.

    ``unfit`` adds a column of that name with a number after it for each type,
    which tells whether the row's value did not fit.
    """
    columns = _named(df, list(types))
    typed = {c: F.col(f"`{c}`").try_cast(t) for c, t in zip(columns, types.values())}
    marks = [F.col(f"`{c}`").isNotNull() & x.isNull() for c, x in typed.items()] if unfit else []
    kept = [typed[c].alias(c) if c in typed else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, *[m.alias(f"{unfit}{i}") for i, m in enumerate(marks)])


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    column: str,
    join_on: str,
    expression: str,
    left_alias: str = LEFT_ALIAS,
    right_alias: str = RIGHT_ALIAS,
    numeric: list[str] | None = None,
) -> DataFrame:
    """Left join ``lookup`` and set ``column`` from an SQL expression over both.

    The result has the columns of ``df`` and the computed one, nothing else of
    the lookup, so a name both sides share cannot get lost. No broadcast is
    forced: Spark broadcasts the lookup when its size allows, and otherwise AQE
    splits the shuffle where one lookup key, or a missing one, is frequent.
    Names compare without case. Columns named in ``numeric`` must be on one of
    the two sides; those of the default list are cast where they are found.
    """
    wanted = NUMERIC_COLUMNS if numeric is None else numeric
    if numeric is not None:
        _named(df.select("*", *[F.lit(None).alias(c) for c in lookup.columns]), numeric)

    def cast(side: DataFrame) -> DataFrame:
        names = {c.lower() for c in side.columns}
        return cast_double(side, [c for c in wanted if c.lower() in names])

    left, right = cast(df).alias(left_alias), cast(lookup).alias(right_alias)
    value = F.expr(expression).alias(column)
    same = column.lower()
    kept = [value if c.lower() == same else F.col(f"{left_alias}.`{c}`") for c in df.columns]
    if same not in {c.lower() for c in df.columns}:
        kept.append(value)
    return left.join(right, F.expr(join_on), "left").select(*kept)


def _step(spark: SparkSession, df: DataFrame, step: dict) -> DataFrame:
    action = step["action"]
    if action == "uppercase":
        return uppercase(df, step["column"])
    if action == "stock_enrichment":
        return enrich(
            df,
            spark.table(step["join_table"]),
            step["column"],
            step["join_on"],
            step["expression"],
            step.get("left_alias", LEFT_ALIAS),
            step.get("right_alias", RIGHT_ALIAS),
            step.get("numeric_columns"),
        )
    raise ValueError(f"a transformation step cannot be {action!r}")


def apply_transformations(spark: SparkSession, df: DataFrame, spec: dict) -> DataFrame:
    """Apply the steps of a spec in list order; no steps, no change."""
    return reduce(lambda out, step: _step(spark, out, step), spec.get("transformations") or [], df)


def add_audit_columns(df: DataFrame, pipeline: str, layer: str) -> DataFrame:
    """Append ``_pipeline``, ``_layer`` and ``_loaded_at``."""
    return df.withColumns(
        {"_pipeline": F.lit(pipeline), "_layer": F.lit(layer), "_loaded_at": F.current_timestamp()}
    )


AUDIT_COLUMNS = ("_pipeline", "_layer", "_loaded_at")
