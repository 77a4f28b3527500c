"""Tables on Parquet: overwrite, upsert by key, and evolving append.

Every write goes to a new folder below the table's path, and the table (or the
partitions that a partitioned upsert touches) is then pointed at it. Readers
see the old or the new content of a folder, never half of either, and a write
that fails leaves the table as it was. The switch is made under a claim
(``claims``), so that of two writers over the same version one is refused.
"""

from __future__ import annotations

import queue
import threading
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.operators import claims
from terrace.session import input_bytes, scratch, sized_for, written

PART = "_part"  # column of a partitioned table: the hash of the key
METRICS_WAIT = 60.0  # seconds that observed metrics may lag behind the write
MAX_FOLDERS = 64  # appended folders after which a table is compacted
FILE = 256 << 20  # bytes of a compacted file, about
UNUSED = "_unused"  # marks a folder that no table or partition is at, since when it was written


class TableChanged(RuntimeError):
    """Another writer has changed the table since it was read; nothing was written to it."""


def ensure_database(spark: SparkSession, database: str, location: str) -> None:
    place = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")


def _same(a: StructType, b: StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table; nothing if there is no such table."""
    try:
        return {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return {}


def _buckets(facts: dict[str, str]) -> int | None:
    return int(facts["Num Buckets"]) if facts.get("Num Buckets") else None


def location_of(spark: SparkSession, table: str) -> str | None:
    """Where a table's rows are just now; None if there is no such table."""
    return _facts(spark, table).get("Location")


def buckets_of(spark: SparkSession, table: str) -> int | None:
    """Into how many buckets a table's keys are dealt; None if they are not."""
    return _buckets(_facts(spark, table))


def _rename(spark: SparkSession, table: str, new: str) -> None:
    """The new name goes without its catalog, in which the table stays."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {'.'.join(new.split('.')[-2:])}")


def _quoted(place: str) -> str:
    return "'" + place.replace("'", "\\'") + "'"


def _finish(spark: SparkSession, table: str):
    """Finishes what another writer was about to switch when it died.

    Its rows were all written by then. If the table is where that writer found it,
    or on the way, the rest is switched; if it is elsewhere, the writer was not
    the first and nothing is done.
    """

    def finish(intent: dict) -> None:
        if "parts" in intent:
            old = {int(p): place for p, place in intent["before"].items()}
            new = {int(p): place for p, place in intent["parts"].items()}
            now = _places(spark, table, list(new))
            if all(now.get(p) in (old.get(p), _uri(spark, new[p]), new[p]) for p in new):
                _switch_parts(spark, table, new, now)
        elif "new" in intent:  # a table of another schema, under another name
            if spark.catalog.tableExists(intent["new"]):
                if not spark.catalog.tableExists(table):
                    _rename(spark, intent["new"], table)
                else:
                    spark.sql(f"DROP TABLE {intent['new']}")
            if spark.catalog.tableExists(intent["old"]):
                spark.sql(f"DROP TABLE {intent['old']}")

    return finish


def _uri(spark: SparkSession, place: str) -> str:
    """A folder's name as the catalog gives it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def settle(spark: SparkSession, table: str, path: str) -> None:
    """Finish the switch of a writer that died on the way, if there is one."""
    claims.settle(spark, path, _finish(spark, table))


def publish(
    spark: SparkSession,
    table: str,
    path: str,
    location: str,
    schema: StructType,
    before: str | None,
    buckets: tuple[int, str] | None = None,
) -> None:
    """Point ``table`` at ``location``, replacing its schema if it changed.

    ``before`` is where the table was when the writer began; if it has moved
    since, the write is refused. A new schema, or other buckets, take a new table
    under another name, which then takes the old one's place.
    """
    new, old = (f"{table}_{uuid4().hex}" for _ in range(2))
    with claims.claim(spark, path, {"new": new, "old": old}, _finish(spark, table)) as held:
        facts = _facts(spark, table)
        if facts.get("Location") != before or not held():
            raise TableChanged(f"{table} was changed by another writer")
        if before is None:
            _create(spark, table, location, schema, buckets)
        elif _same(spark.table(table).schema, schema) and _buckets(facts) == (buckets and buckets[0]):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(location)}")
            spark.catalog.refreshTable(table)
        else:
            _create(spark, new, location, schema, buckets)
            _rename(spark, table, old)
            _rename(spark, new, table)
            spark.sql(f"DROP TABLE {old}")
        claims.Folder(spark, location).delete(UNUSED)


def _create(
    spark: SparkSession, table: str, location: str, schema: StructType, buckets: tuple[int, str] | None
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    dealt = f"CLUSTERED BY (`{buckets[1]}`) SORTED BY (`{buckets[1]}`) INTO {buckets[0]} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {dealt} LOCATION {_quoted(location)}")


def _observed(seen: Observation) -> dict | None:
    """The metrics of a finished write; None if they do not arrive."""
    box: queue.Queue = queue.Queue()

    def wait() -> None:
        try:
            box.put(dict(seen.get))
        except Exception:  # the written rows are counted instead
            box.put(None)

    threading.Thread(target=wait, daemon=True).start()
    try:
        return box.get(timeout=METRICS_WAIT)
    except queue.Empty:
        return None


def write_version(
    df: DataFrame,
    path: str,
    metrics: list[Column] = (),
    by: str | None = None,
    buckets: tuple[int, str] | None = None,
    keep: list[str] | None = None,
    bucket_table: str | None = None,
) -> tuple[str, dict]:
    """Write a frame to a new folder; returns the folder and the metrics of its rows.

    The row count and ``metrics`` ride on the write. They sit above the last
    shuffle, in the stage whose tasks count once however often they are retried.
    Where Spark's listener loses them, the written folder is read instead, or the
    frame once more if only the columns ``keep`` of it were written. With
    ``buckets``, a number and a key, the files are those of a table so dealt.
    """
    location = f"{path}/{uuid4().hex}"
    every = [F.count(F.lit(1)).alias("rows"), *metrics]
    seen = Observation()
    watched = df.observe(seen, *every)
    writer = (watched.select(*keep) if keep else watched).write
    if buckets:
        name = f"{bucket_table}_{uuid4().hex}"  # only a table can be written in buckets
        dealt = writer.bucketBy(buckets[0], buckets[1]).sortBy(buckets[1])
        dealt.option("path", location).format("parquet").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    else:
        (writer.partitionBy(by) if by else writer).parquet(location)
    found = _observed(seen)
    if found is None or len(found) != len(every):
        again = df if keep else df.sparkSession.read.schema(df.schema).parquet(location)
        found = again.agg(*every).first().asDict()
    return location, found


def overwrite(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    path: str,
    metrics: list[Column] = (),
    keep: list[str] | None = None,
    buckets: tuple[int, str] | None = None,
    order_by: list[str] | None = None,
) -> dict:
    """Replace content and schema of a table; returns ``rows`` and the metrics.

    ``keep`` names the columns to write, where metrics need more of them.
    ``order_by`` sorts the rows over all files of the table: they are written
    once, cut into ranges there, and each range is sorted, so that finding the
    ranges does not compute the frame a second time.
    """
    settle(spark, table, path)
    before = location_of(spark, table)
    with sized_for(spark, input_bytes(df)), scratch(spark, "overwrite") as place:
        if order_by:
            df = written(df, place).repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        if buckets:
            df = df.repartition(buckets[0], F.col(f"`{buckets[1]}`"))
        location, observed = write_version(df, path, metrics, None, buckets, keep, table)
    schema = df.select(*keep).schema if keep else df.schema
    publish(spark, table, path, location, schema, before, buckets)
    return observed


def align(source: DataFrame, schema: StructType) -> DataFrame:
    """The source with exactly the columns and types of a target.

    Extra source columns are ignored; a missing one is an error.
    """
    have = {c.lower() for c in source.columns}
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"source lacks target columns: {', '.join(missing)}")
    return source.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def _told_apart(target: DataFrame, source: DataFrame, key: str, place: str) -> tuple[DataFrame, list[DataFrame]]:
    """The source rows with a key of their own, and frames of those that can only be inserted.

    A null key matches nothing. A source key that is repeated *and* present in
    the target is refused, since it would not be clear which row wins. So null
    and repeated source keys are pure inserts. Repeated keys, if there are any, are
    written to ``place``, so that Spark knows their size.
    """
    has_key = F.col(key).isNotNull()
    counts = source.groupBy(key).agg(F.count("*").alias("_n"))
    several = has_key & (F.col("_n") > 1)
    facts = counts.agg(F.count_if(several).alias("repeated"), F.count_if(~has_key).alias("nulls")).first()
    single, inserts = source.where(has_key), []
    if facts.nulls:
        inserts.append(source.where(~has_key))
    if facts.repeated:
        counts.where(several).select(key).write.parquet(place)
        repeated = source.sparkSession.read.schema(source.select(key).schema).parquet(place)
        clash = target.select(key).join(repeated, key, "left_semi").first()
        if clash is not None:
            raise ValueError(f"several source rows match target key {clash[0]!r}")
        inserts.append(single.join(repeated, key, "left_semi").select(source.columns))
        single = single.join(repeated, key, "left_anti").select(source.columns)
    return single, inserts


def merged(target: DataFrame, source: DataFrame, key: str, place: str, buckets: int | None = None) -> DataFrame:
    """The target after an upsert: matched rows updated in all columns, source
    rows without a match added, all other target rows kept.

    The source side of the joins is unique (``_told_apart``). They are a left join
    of the target, in which AQE can split a frequent key, and an anti join of the
    source with the target's distinct keys, which shrink in each task. Both read
    the same shuffle of the source.

    A target in ``buckets`` by its key is not shuffled at all: one full outer
    join meets the source where the target's files are. A frequent key is in one
    bucket as it is, so this is for tables whose key is one, nearly.
    """
    source = align(source, target.schema)
    single, inserts = _told_apart(target, source, key, place)
    t, s = target.alias("t"), single.alias("s")
    hit = F.col(f"t.`{key}`") == F.col(f"s.`{key}`")
    matched = F.col(f"s.`{key}`").isNotNull()
    joined = t.join(s, hit, "full" if buckets else "left").select(
        [F.when(matched, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in target.columns]
    )
    if buckets:
        return reduce(DataFrame.union, [x.repartition(buckets, key) for x in inserts], joined)
    known = target.select(key).where(F.col(key).isNotNull()).distinct().alias("t")
    return reduce(DataFrame.union, [s.join(known, hit, "left_anti"), *inserts], joined)


def upsert(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    path: str,
    key: str | None,
    materialize: bool = False,
    metrics: list[Column] = (),
    keep: list[str] | None = None,
) -> dict:
    """Upsert into a table by one key column; returns the ``rows`` it then has.

    The source is read several times; ``materialize`` writes it first, for one
    that is costly to compute. ``metrics`` are those of the source, which is
    then written first, too, with the columns ``keep``.
    """
    if not key:
        raise ValueError(f"a merge key is needed to write into the existing table {table}")
    settle(spark, table, path)
    facts, target, seen = _facts(spark, table), spark.table(table), {}
    before, n = facts["Location"], _buckets(facts)
    with scratch(spark, "upsert") as place:
        if materialize or metrics:
            with sized_for(spark, input_bytes(source)):
                where, seen = write_version(source, f"{place}/source", metrics, keep=keep)
            source = spark.read.schema((source.select(*keep) if keep else source).schema).parquet(where)
        if PART in target.columns:
            return seen | _upsert_parts(spark, source, table, path, key)
        sizes = input_bytes(target), input_bytes(source)
        with sized_for(spark, sum(sizes) if None not in sizes else None, n):
            new = merged(target, source, key, f"{place}/repeated", n)
            location, observed = write_version(new, path, buckets=(n, key) if n else None, bucket_table=table)
    publish(spark, table, path, location, target.schema, before, (n, key) if n else None)
    return seen | observed


def first_load_or_upsert(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    path: str,
    key: str | None,
    partition_by: int | None = None,
    materialize: bool = False,
    metrics: list[Column] = (),
    keep: list[str] | None = None,
    buckets: int | None = None,
) -> dict:
    """Create the table from the frame, or upsert into it once it exists.

    With ``partition_by`` a new table is dealt into so many partitions by the
    hash of its key (in the extra last column ``_part``), and later upserts
    rewrite only the partitions that hold a key of the source. With ``buckets``
    its files are so many buckets by the key, and later upserts do not shuffle it.
    """
    settle(spark, table, path)
    if spark.catalog.tableExists(table):
        return upsert(spark, df, table, path, key, materialize, metrics, keep)
    if (partition_by or buckets) and not key:
        raise ValueError(f"{table} can only be dealt out by a merge key")
    if partition_by and buckets:
        raise ValueError(f"{table} can be dealt into partitions or buckets, not both")
    if not partition_by:
        return overwrite(spark, df, table, path, metrics, keep, (int(buckets), key) if buckets else None)
    with sized_for(spark, input_bytes(df)):
        parted = df.withColumn(PART, _part(key, partition_by))
        columns = [*keep, PART] if keep else parted.columns
        dealt = parted.repartition(PART, _spread(parted.select(*columns)))
        location, observed = write_version(dealt, path, metrics, by=PART, keep=keep and columns)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parted.select(*columns).schema)
    intent = {"new": f"{table}_{uuid4().hex}", "old": f"{table}_{uuid4().hex}"}
    with claims.claim(spark, path, intent, _finish(spark, table)):
        if spark.catalog.tableExists(table):
            raise TableChanged(f"{table} was created by another writer")
        spark.sql(
            f"CREATE TABLE {intent['new']} ({names}) USING parquet PARTITIONED BY ({PART}) "
            f"LOCATION {_quoted(location)} TBLPROPERTIES ('parts' = '{int(partition_by)}')"
        )
        spark.sql(f"MSCK REPAIR TABLE {intent['new']}")
        _rename(spark, intent["new"], table)
    return observed


def _part(key: str, n: int) -> Column:
    """Partition of a key; null keys are in the first one."""
    return F.coalesce(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)), F.lit(0)).cast("int")


def _spread(df: DataFrame) -> Column:
    """Deals the rows of a partition over some tasks, those of a frequent key, too.

    It depends on the row alone: a task that runs again sends its rows where it
    sent them before. Equal rows go together.
    """
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(8))


def _places(spark: SparkSession, table: str, parts: list[int]) -> dict[int, str]:
    """Where the rows of some partitions are just now."""
    known = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    out = {}
    for p in known & set(parts):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({PART} = {p})")
        out[p] = rows.where("col_name = 'Location'").select("data_type").first()[0]
    return out


def _switch_parts(spark: SparkSession, table: str, new: dict[int, str], now: dict[int, str]) -> None:
    """Point partitions at their new folders; those that are there already stay."""
    added = [p for p in new if p not in now]
    for p, place in new.items():
        if p in now and now[p] not in (place, _uri(spark, place)):
            spark.sql(f"ALTER TABLE {table} PARTITION ({PART} = {p}) SET LOCATION {_quoted(place)}")
    if added:
        several = " ".join(f"PARTITION ({PART} = {p}) LOCATION {_quoted(new[p])}" for p in added)
        spark.sql(f"ALTER TABLE {table} ADD {several}")
    spark.catalog.refreshTable(table)
    for place in new.values():
        claims.Folder(spark, place).delete(UNUSED)


def _upsert_parts(spark: SparkSession, source: DataFrame, table: str, path: str, key: str) -> dict:
    """Upsert that rewrites only the partitions with a key of the source, and leaves the others' files alone."""
    target = spark.table(table)
    parts = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('parts')").first()[1])
    with scratch(spark, "upsert") as place:
        dealt = source.withColumn(PART, _part(key, parts))
        align(dealt, target.schema).write.parquet(f"{place}/source")
        dealt = spark.read.schema(target.schema).parquet(f"{place}/source")
        touched = sorted(r[0] for r in dealt.select(PART).distinct().collect())  # at most as many as there are partitions
        before = _places(spark, table, touched)
        old = target.where(F.col(PART).isin(touched))
        sizes = input_bytes(dealt), input_bytes(target)
        with sized_for(spark, sum(sizes) if None not in sizes else None):
            new = merged(old, dealt, key, f"{place}/repeated")
            location, _ = write_version(new.repartition(PART, _spread(new)), path, by=PART)
    switch = {p: f"{location}/{PART}={p}" for p in touched}
    intent = {"before": before, "parts": switch}
    with claims.claim(spark, path, intent, _finish(spark, table)) as held:
        now = _places(spark, table, touched)
        if now != before or not held():
            raise TableChanged(f"{table} was changed by another writer")
        _switch_parts(spark, table, switch, now)
    return {"rows": spark.table(table).count()}


def append(spark: SparkSession, df: DataFrame, table: str, path: str, most: int = MAX_FOLDERS) -> None:
    """Append by column name; new columns are added to the table, absent ones are null.

    The rows are written beside the table and moved into its folder under the
    claim, as a folder of their own. Once there are ``most`` of those, they are compacted.
    """
    staged = f"_staged-{uuid4().hex}"
    df.write.parquet(f"{path}/{staged}")
    folder = claims.Folder(spark, path)
    with claims.claim(spark, path, {}, _finish(spark, table)):
        if not spark.catalog.tableExists(table):
            version = uuid4().hex
            folder.fs.mkdirs(folder._at(version))
            spark.catalog.createTable(
                table, path=f"{path}/{version}", source="parquet", schema=df.schema, recursiveFileLookup="true"
            )
        try:
            _add_columns(spark, df, table)
        except ValueError:
            folder.delete(staged)
            raise
        version = location_of(spark, table).rsplit("/", 1)[1]
        if not folder.rename(staged, f"{version}/{uuid4().hex}"):
            raise OSError(f"{path}/{staged} cannot be moved into the table")
        spark.catalog.refreshTable(table)
        if len(folder.names(version)) >= most:
            _compact(spark, table, path)


def _add_columns(spark: SparkSession, df: DataFrame, table: str) -> None:
    known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    for field in df.schema:
        old = known.get(field.name.lower(), field.dataType)
        if old != field.dataType:
            raise ValueError(f"column {field.name} of {table} is {old.simpleString()}")
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def _compact(spark: SparkSession, table: str, path: str) -> None:
    """Rewrite an appended table, whose claim is held, as one folder of a new version."""
    rows = spark.table(table)
    size = input_bytes(rows) or 0
    version = f"{path}/{uuid4().hex}"
    rows.coalesce(max(1, size // FILE)).write.parquet(f"{version}/{uuid4().hex}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(version)}")
    spark.catalog.refreshTable(table)


def compact(spark: SparkSession, table: str, path: str) -> None:
    """Rewrite an appended table as few files. Appends wait; readers see the old folders or the new one."""
    with claims.claim(spark, path, {}, _finish(spark, table)):
        _compact(spark, table, path)


def remove_old_versions(spark: SparkSession, table: str, path: str, older_than: float = 7 * 86400.0) -> list[str]:
    """Remove the folders below a table's path that have been out of use for ``older_than`` seconds; returns them.

    A folder may be read long after the table has left it, and may be one that is
    just being written. So the first call that finds it out of use marks it, and a
    later one removes it when the mark is old enough. What is in use loses its
    mark. Of a partitioned table each partition's folder counts alone.
    """
    folder, gone = claims.Folder(spark, path), []
    with claims.claim(spark, path, {}, _finish(spark, table)):
        facts = _facts(spark, table)
        used = {facts["Location"]}
        if PART in spark.table(table).columns:
            parts = [int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
            used |= set(_places(spark, table, parts).values())
        used = {_uri(spark, x) for x in used}
        every = [n for n in folder.names() if folder.is_folder(n)]
        places = []
        for name in every:
            inner = [f"{name}/{p}" for p in folder.names(name) if p.startswith(f"{PART}=")]
            places += inner or [name]
        for name in places:
            age = folder.age(f"{name}/{UNUSED}")
            if _uri(spark, f"{path}/{name}") in used:
                if age is not None:
                    folder.delete(f"{name}/{UNUSED}")
            elif age is None:
                folder.create(f"{name}/{UNUSED}", "")
            elif age > older_than:
                folder.delete(name)
                gone.append(name)
    return gone
