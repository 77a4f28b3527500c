"""Outer joins shaped so that a hot key cannot end up in a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(
    left: DataFrame, right: DataFrame, key: str, keys_of: DataFrame | None = None
) -> DataFrame:
    """Left outer equi-join on a shared column, safe when either side has hot keys.

    AQE can split skewed rows on either side of an inner join but not on the
    optional side of an outer one. So the rows with a match come from an inner
    join, and the others from an anti join with the distinct keys, where a hot
    key has shrunk to one row per task before it is shuffled. ``keys_of`` may
    name a frame in which the same keys are cheaper to read, for instance the
    table that ``right`` was enriched from. Rows without a key go apart, so that both
    joins read the same rows of ``left``, which are then computed and shuffled once.
    """
    rest = [f for f in right.schema if f.name.lower() != key.lower()]
    known = (right if keys_of is None else keys_of).select(key).distinct()
    keyed = left.where(F.col(key).isNotNull())
    alone = keyed.join(known, key, "left_anti")  # the key comes first
    at = [c.lower() for c in left.columns].index(key.lower())
    places = [f"_{i}" for i in range(len(left.columns))]  # other names may stand twice
    keyless = left.where(F.col(key).isNull()).toDF(*places).select(places[at], *places[:at], *places[at + 1 :])
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rest]
    return keyed.join(right, key).union(alone.union(keyless).select("*", *empty))


def once_per_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The rows of a left outer join that takes no column of ``right``.

    Only keys that ``right`` has several times make a difference, so ``left``
    meets those alone, and nothing at all if there are none. That is looked up
    when the frame is built, in the key column of ``right``.
    """
    counts = right.where(F.col(right_key).isNotNull()).groupBy(right_key).agg(F.count("*").alias("_times"))
    several = counts.where("_times > 1").withColumnRenamed(right_key, "_key")
    if several.isEmpty():
        return left
    joined = left.join(several, F.col(left_key) == F.col("_key"), "left")
    times = F.sequence(F.lit(1).cast("bigint"), F.coalesce("_times", F.lit(1)))
    return joined.withColumn("_time", F.explode(times)).select(left.columns)
