"""Session helpers: a shared work folder and shuffle sizing."""

from __future__ import annotations

import shutil
import tempfile
import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PARTITION = 128 << 20  # bytes of input for one shuffle partition
MAX_SHUFFLE_PARTITIONS = 50_000  # what the driver's table of map outputs is good for
FINE = 16 << 20  # bytes of input for one, as long as that gives no more than
FINE_PARTITIONS = 16_000
TASK = 16 << 20  # bytes of a shuffle that one task reads; sorted or hashed they take some 20 times as much memory
HASHED = 16 << 20  # bytes of a shuffle partition up to which a join may hash it instead of sorting both sides
SKEWED = 64 << 20  # bytes of a shuffle partition from which it may be split
MAX_SCAN_TASKS = 100_000
UNKNOWN = 1 << 62  # Spark gives a size that it does not know as one like this
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_settings: dict[int, threading.RLock] = defaultdict(threading.RLock)  # by session


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables a job writes on its way.

    The cluster names it in ``spark.checkpoint.dir``. Where that is not set it
    is a folder in the warehouse, which all executors reach, too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder in the shared one, which is removed afterwards."""
    place = f"{shared_dir(spark)}/{name}-{uuid4().hex}"
    try:
        yield place
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, for Python workers that do not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    if root.suffix != ".zip":  # else it came that way
        place = tempfile.mkdtemp(prefix="terrace-")  # on the driver, which hands it out
        context.addPyFile(shutil.make_archive(f"{place}/terrace", "zip", root, "terrace"))
    _shipped.add(context.applicationId)


def written(df: DataFrame, place: str) -> DataFrame:
    """A frame as files at ``place``, read back: what follows, be it several reads, does not compute it again."""
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def few_rows(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A handful of driver-side rows as a frame of one partition."""
    named = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, schema)).coalesce(1)


def input_bytes(*frames: DataFrame) -> int | None:
    """Size of what some frames read, as Spark's plan has it; None if it does not know.

    Spark has listed the files when the frame was built, so this lists and reads nothing.
    """
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        total += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total if total < UNKNOWN else None


def _at_most(spark: SparkSession, name: str, n_bytes: int) -> str:
    """A size that the session has set, or ``n_bytes`` where that is less or none is set."""
    own = spark.conf.get(name, None)
    return own if own and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) < n_bytes else f"{n_bytes}b"


def shuffle_settings(spark: SparkSession, n_bytes: int | None) -> dict[str, str]:
    """Scan and shuffle sizes for an input of ``n_bytes``; for an unknown one the session's own.

    AQE can merge shuffle partitions but never adds any, so the initial number
    has to follow the data, bounded so that the map output table still fits the
    driver. Scan tasks grow with the input for the same reason. Small inputs
    keep the session's own numbers. Skewed joins are split even where that
    costs another shuffle.

    Partitions are merged up to ``TASK`` bytes only: shuffled bytes are compressed,
    and a larger partition would fill a task's memory as the input grows. They are
    fine for that up to 250 GB of input; beyond 2 TB they grow with it. Where no
    partition of a side is larger than ``HASHED``, AQE hashes it and sorts neither.
    """
    settings = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    for name, most in (("advisoryPartitionSizeInBytes", TASK), ("skewJoin.skewedPartitionThresholdInBytes", SKEWED)):
        settings[f"spark.sql.adaptive.{name}"] = _at_most(spark, f"spark.sql.adaptive.{name}", most)
    settings["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"] = f"{HASHED}b"
    if n_bytes is None:
        return settings
    own = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    default = int(own)
    wanted = max(min(n_bytes // FINE, FINE_PARTITIONS), n_bytes // PARTITION)
    settings[INITIAL_PARTITIONS] = str(min(max(default, wanted), max(default, MAX_SHUFFLE_PARTITIONS)))
    if n_bytes // MAX_SCAN_TASKS > 128 << 20:
        settings["spark.sql.files.maxPartitionBytes"] = str(n_bytes // MAX_SCAN_TASKS)
    return settings


@contextmanager
def sized_for(spark: SparkSession, n_bytes: int | None, buckets: int | None = None) -> Iterator[dict[str, str]]:
    """Run a block under ``shuffle_settings`` and put the old values back.

    With ``buckets`` shuffles have as many partitions, so that a table dealt into
    those by its key is joined where it is. The settings belong to the session,
    so threads that share one take turns.
    """
    with _settings[hash(spark._jsparkSession)]:
        settings = shuffle_settings(spark, n_bytes)
        if buckets:
            settings |= dict.fromkeys((INITIAL_PARTITIONS, "spark.sql.shuffle.partitions"), str(buckets))
        before = {name: spark.conf.get(name, None) for name in settings}
        try:
            for name, value in settings.items():
                spark.conf.set(name, value)
            yield settings
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def written_sized(df: DataFrame, place: str) -> DataFrame:
    """``written`` with shuffles sized for what the frame reads, which a frame that is returned unwritten does not have."""
    with sized_for(df.sparkSession, input_bytes(df)):
        return written(df, place)
