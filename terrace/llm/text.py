"""What several operators share: words, rows as chunks, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import shared_dir

BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def whole(column: str = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def running(numbers: Column, block: int = 256) -> Column:
    """The running sums of an array of ints that has elements.

    Sums are appended one by one within blocks and over the blocks' totals, so
    that the copying this takes stays small for long arrays.
    """

    def sums(part: Column) -> Column:
        def add(done: Column, x: Column) -> Column:
            return F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + x))

        return F.aggregate(part, F.array().cast("array<int>"), add)

    def of(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(all_) - 1, F.lit(block))
        return let(F.transform(starts, lambda b: sums(F.slice(all_, b + 1, block))), after)

    def after(parts: Column) -> Column:
        totals = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(totals, lambda t: F.flatten(F.transform(parts, lambda p, i: raised(p, F.get(t, i - 1)))))

    def raised(part: Column, by: Column) -> Column:
        return F.transform(part, lambda x: x + F.coalesce(by, F.lit(0)))

    return let(numbers, of)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text that is not null; none gives an empty array."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def remainder(column: str, n: int) -> Column:
    """crc32 of a value as text, mod ``n``; of the empty text for null."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def by_all(df: DataFrame) -> list[Column]:
    """An order of rows by all columns, so that only equal rows stand in no order."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return plain + [F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema if "map<" in f.dataType.simpleString()]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage, so that a lost executor costs no recomputation, and
    tells Spark the true size of the frame.
    """
    spark = df.sparkSession
    place = f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
    df.write.parquet(place)
    read = spark.read.schema(df.schema).parquet(place)
    read._stored_at = place
    return read


def discard(*frames: DataFrame) -> None:
    """Remove tables that ``stored`` wrote and that nothing reads any more, such as those of earlier rounds."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The content of a file of the driver, such as a vocabulary of a few MB, for tasks to read."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def bounded(batch: pa.RecordBatch, sizes: np.ndarray, most: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``sizes`` add up to about ``most``; a larger row is a slice alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most or i - start >= rows:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def text_chunks(batch: pa.RecordBatch, column: str, chars: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``chars`` bytes of text each."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    yield from bounded(batch, sizes, chars)


def list_chunks(batch: pa.RecordBatch, column: str, values: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``values`` list values each."""
    yield from bounded(batch, np.diff(batch.column(column).offsets.to_numpy()), values)


def list_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row offsets (from 0) of a list column without nulls."""
    lists = batch.column(name)
    offsets = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), (offsets - offsets[0]).astype(np.int64)


def over_chunks(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that works on slices of bounded text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for chunk in text_chunks(batch, column):
                    yield work(chunk)

    return run


def sql_crc32(column: str) -> str:
    """DuckDB SQL for the crc32 of a whole number as text, bit by bit; null for null."""
    characters = f"list_transform(string_split({column}::varchar, ''), lambda c: ascii(c)::bigint)"
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    byte = f"list_reduce(list_prepend(xor(x, y), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: {step})"
    return f"(4294967295 - list_reduce(list_prepend(4294967295::bigint, {characters}), lambda x, y: {byte}))"
