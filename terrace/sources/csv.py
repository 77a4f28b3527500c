"""CSV sources. Every column arrives as a string; types are set later."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MALFORMED = "_malformed"  # column of rows whose line had too few or too many fields
QUOTED = r'"(?:[^"\\]|\\.)*"'


def read_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, has_header: bool = True
) -> DataFrame:
    """Scan CSV files as strings and keep ``columns`` (all when not given).

    With a header the columns are picked by name, and an unknown name is an
    error. Without one they name the fields by position.
    """
    df = spark.read.csv(path, header=has_header, inferSchema=False)
    if not columns:
        return df
    return df.select(*columns) if has_header else df.toDF(*columns)


def read_marked_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, has_header: bool = True
) -> DataFrame:
    """The rows of ``read_csv`` with ``_malformed``: whether a row's line did not have as many fields as the file.

    Such a line gives the fields that it has, further ones null, and more than
    the file's are cut, as in ``read_csv``, which tells nothing of it. So lines are
    read as text here, and their commas outside of quotes counted. Lines equal
    to the first one are taken for headers, if there are any; blank ones are skipped.
    """
    names = spark.read.csv(path, header=has_header, inferSchema=False).columns
    if not has_header and columns:
        names = columns
    schema = ", ".join(f"`{c}` string" for c in names)
    lines = spark.read.text(path).where(F.trim("value") != "")
    if has_header and (first := lines.first()):
        lines = lines.where(F.col("value") != first[0])
    bare = F.regexp_replace("value", QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    rows = lines.select(F.from_csv("value", schema).alias("r"), (fields != len(names)).alias(MALFORMED))
    return rows.select(*[F.col(f"r.`{c}`") for c in columns or names], MALFORMED)


def read_source(spark: SparkSession, spec: dict) -> DataFrame:
    """The pipeline's source: scan, projection, then full-row duplicate removal.

    Nulls count as equal when rows are compared. Spark removes copies within
    each scan task before the shuffle, so a row repeated any number of times
    sends at most one copy per task to the same place. Where the spec says what
    to do with malformed lines (``source.malformed``), ``_malformed`` tells which
    rows come from one; of equal rows one such is enough.
    """
    source = spec["source"]
    place = source["path"], source.get("columns"), source.get("has_header", True)
    if not source.get("malformed"):
        return read_csv(spark, *place).dropDuplicates()
    df = read_marked_csv(spark, *place)
    return df.groupBy(*df.columns[:-1]).agg(F.bool_or(MALFORMED).alias(MALFORMED))
