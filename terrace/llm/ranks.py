"""Positions of rows within their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.text import stored
from terrace.session import MAX_SHUFFLE_PARTITIONS, input_bytes

RANGE = 64 << 20  # bytes of rows in one range, about
BLOCK = 1 << 20  # equal rows that one task writes out


def ranges_for(rows: DataFrame) -> int:
    """How many ranges some written rows take: by their bytes, and at least one for each shuffle partition."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, (input_bytes(rows) or 0) // RANGE), max(least, MAX_SHUFFLE_PARTITIONS))


def written_out(counted: DataFrame) -> DataFrame:
    """Rows with a count ``_n`` as so many rows, told apart by ``_copy`` from 0; many copies by many tasks."""
    few = counted.where(F.col("_n") <= BLOCK).withColumn("_first", F.lit(0).cast("long"))
    many = counted.where(F.col("_n") > BLOCK)
    blocks = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BLOCK).cast("long"))
    many = many.withColumn("_first", F.explode(blocks))
    many = many.repartition(*many.columns)
    last = F.least(F.col("_first") + BLOCK, F.col("_n")) - 1
    every = few.unionByName(many)
    return every.withColumn("_copy", F.explode(F.sequence(F.col("_first"), last))).drop("_first", "_n")


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``at``, their place in their group from 0, and ``size``, the rows of the group.

    ``group`` is a column without nulls; ``order`` sorts ascending, nulls first,
    and all other columns break ties, so that only equal rows stand in no order.
    No task holds a group: the rows are sorted into ranges over (group, order),
    equal rows by their number, each counted within its range, and to that comes
    what the group has in earlier ranges. An empty table gives an empty one.
    """
    rest = [c for c in rows.columns if c not in (group, *order)]
    counted = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")), "counted")
    by = [group, *order, *rest, "_copy"]
    dealt = written_out(counted).repartitionByRange(ranges_for(counted), *by).sortWithinPartitions(*by)
    nth = F.monotonically_increasing_id()  # of a sorted range, and written with it
    ranged = stored(dealt.drop("_copy").withColumn("_nth", nth).withColumn("_range", F.shiftright("_nth", 33)), "ranged")
    parts = ranged.groupBy(group, "_range").agg(F.min("_nth").alias("_start"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        group,
        "_range",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("size"),
    )
    placed = ranged.join(stored(parts, "ranges"), [group, "_range"])
    return stored(placed.select(*rows.columns, (F.col("_nth") + F.col("_shift")).alias("at"), "size"), "placed")
