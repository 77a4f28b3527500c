"""The trie of conversation prefixes, its subtrees summed by depth bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.merkle import digest, field
from terrace.llm.ranks import positions, ranges_for
from terrace.llm.text import remainder, sql_crc32, stored

BAND = 16  # depths of a band: a node goes to so many ancestors at most
HEADS = 6  # a rebuilt conversation begins with fewer turns of another one
HUNDRED = 100  # conversations that share one beginning
IDS = 4096  # conversation ids that are hashed as one piece of text
SUMS = ["s0", "s1", "s2", "s3"]
KEY = ["depth", "k0", "k1"]
NODE = "depth long, k0 long, k1 long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, at, mark, chars) numbered in their conversation, and its ``size``.

    ``mark`` is a digest of role and text, null being empty. Turns of one number
    are in the order of their digests, a null turn is the first; equal rows are so
    many turns. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(digest(field(role), field(text))).alias("mark"),
        F.length(text).cast("long").alias("chars"),
    )
    return positions(rows, "conv_id", ["turn", "mark"])


def rebuilt(turns: DataFrame) -> DataFrame:
    """Steps (conv_id, depth, mark, chars, last) of all rebuilt conversations; at depth 0 one for each.

    The first turns come from the first conversation of the same hundred. It lends
    at most five turns to at most 199 conversations, so that join stays small, and
    the other one has a unique side.
    """
    lender = F.col("conv_id") - F.col("conv_id") % HUNDRED
    every = turns.where("at = 0").select(
        "conv_id", "size", remainder("conv_id", HEADS).alias("head"), lender.alias("lender")
    )
    lenders = every.select(F.col("conv_id").alias("lender"), F.col("size").alias("lent"))
    taken = F.least("head", F.coalesce("lent", F.lit(0))).alias("taken")
    every = every.join(lenders, "lender", "left").select("conv_id", "size", "head", "lender", taken)
    length = F.col("taken") + F.greatest(F.col("size") - F.col("head"), F.lit(0))
    every = stored(every.withColumn("length", length), "conversations")

    roots = every.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("mark"), F.lit(0).cast("long").alias("chars"), "length")
    lent = turns.where(F.col("at") < HEADS - 1).select(F.col("conv_id").alias("lender"), "at", "mark", "chars")
    heads = every.select("conv_id", "lender", "head", "length").join(lent, "lender").where("at < head")
    heads = heads.select("conv_id", (F.col("at") + 1).alias("depth"), "mark", "chars", "length")
    tails = turns.select("conv_id", "at", "mark", "chars").join(every.select("conv_id", "head", "taken", "length"), "conv_id")
    tails = tails.where("at >= head").select(
        "conv_id", (F.col("at") - F.col("head") + F.col("taken") + 1).alias("depth"), "mark", "chars", "length"
    )
    steps = roots.unionByName(heads).unionByName(tails)
    return steps.select("conv_id", "depth", "mark", "chars", (F.col("depth") == F.col("length")).alias("last"))


def halves(seed: int) -> list[Column]:
    """A hash of a step and its depth as two numbers of 32 bits; 0 for the step of depth 0."""
    value = F.xxhash64(F.lit(seed), "depth", "mark")
    parts = [F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))]
    return [F.when(F.col("depth") > 0, x).otherwise(F.lit(0).cast("long")) for x in parts]


def summed(steps: DataFrame, deepest: int) -> DataFrame:
    """Steps (conv_id, depth, ...) with the sums of ``SUMS`` over all steps down to each.

    Sums run within bands, so that no task holds a conversation, and the totals of
    the bands are summed in the same way: a depth of n takes log(n) rounds.
    """
    band = F.expr(f"depth div {BAND}")
    along = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = steps.withColumn("band", band).withColumns({c: F.sum(c).over(along) for c in SUMS})
    if deepest < BAND:
        return inner.drop("band")
    inner = stored(inner, "sums")
    totals = steps.groupBy("conv_id", band.alias("depth")).agg(*[F.sum(c).alias(c) for c in SUMS])
    until = summed(stored(totals, "sums"), deepest // BAND)
    before = until.select("conv_id", (F.col("depth") + 1).alias("band"), *[F.col(c).alias(f"before_{c}") for c in SUMS])
    joined = inner.join(before, ["conv_id", "band"], "left")
    return joined.select(
        *[c for c in steps.columns if c not in SUMS],
        *[(F.col(c) + F.coalesce(f"before_{c}", F.lit(0))).alias(c) for c in SUMS],
    )


def keys(sums: list[Column], names: list[str]) -> list[Column]:
    """Four sums as two numbers, each sum modulo 2**32."""
    low = [F.pmod(x, F.lit(1 << 32)) for x in sums]
    return [F.shiftleft(low[i], 32).bitwiseOR(low[i + 1]).alias(n) for i, n in zip((0, 2), names)]


def prefixes(steps: DataFrame) -> tuple[DataFrame, int]:
    """Steps with the key of the prefix that ends there (k0, k1) and of the one before (up0, up1), and the greatest depth.

    A key is the sum of hashes of the steps and their depths, 128 bits in all:
    sums can be taken in pieces, so a conversation may have any number of turns.
    """
    hashed = stored(steps.select("*", *[x.alias(c) for x, c in zip(halves(1) + halves(2), SUMS)]), "steps")
    deepest = hashed.agg(F.max("depth")).first()[0] or 0
    own = dict(zip(SUMS, halves(1) + halves(2)))
    rows = summed(hashed, deepest).select(
        "conv_id",
        "depth",
        "chars",
        "last",
        *keys([F.col(c) for c in SUMS], ["k0", "k1"]),
        *keys([F.col(c) - own[c] for c in SUMS], ["up0", "up1"]),
    )
    return stored(rows, "prefixes"), deepest


def totals(paths: DataFrame, nodes: DataFrame, deepest: int, values: list[str]) -> DataFrame:
    """The sums of some values over the subtree of each node (``KEY``).

    ``paths`` has the key of each (conv_id, depth); ``nodes`` a row per node with
    one of its conversations, of which the parent is ``up0, up1``. Within bands of
    ``BAND`` depths a node's value goes to its ancestors, which are those steps of
    its conversation; the nodes of one conversation in one band go together. What
    hangs below a band is the totals of the next band's roots. They are the same
    sums over a tree that has the roots of the bands alone, and are found first.
    """
    band = F.expr(f"depth div {BAND}")
    if deepest >= BAND:
        within = nodes.groupBy("conv_id", band.alias("band")).agg(*[F.sum(v).alias(v) for v in values])
        at_root = F.col("depth") % BAND == 0
        tops = paths.where(at_root).withColumn("depth", band)
        tops = stored(tops, "tops")
        inside = within.join(tops, (within.conv_id == tops.conv_id) & (F.col("band") == F.col("depth")))
        inside = inside.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])
        roots = nodes.where(at_root).select("conv_id", band.alias("depth"), "k0", "k1", "up0", "up1")
        roots = stored(roots, "roots")
        over = tops.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("k0").alias("up0"), F.col("k1").alias("up1"))
        reduced = roots.drop("up0", "up1").join(inside, KEY).join(over, ["conv_id", "depth"], "left")
        done = totals(tops, stored(reduced, "reduced"), deepest // BAND, values)
        below = roots.where("depth > 0").join(done, KEY)
        below = below.groupBy((F.col("depth") * BAND - 1).alias("depth"), F.col("up0").alias("k0"), F.col("up1").alias("k1"))
        below = below.agg(*[F.sum(v).alias(f"below_{v}") for v in values])
        with_below = nodes.join(below, KEY, "left")
        more = {v: F.col(v) + F.coalesce(f"below_{v}", F.lit(0)) for v in values}
        nodes = with_below.withColumns(more).drop(*[f"below_{v}" for v in values])
    own = nodes.groupBy("conv_id", band.alias("band")).agg(F.collect_list(F.struct("depth", *values)).alias("own"))
    up = paths.withColumn("band", band).join(stored(own, "bands"), ["conv_id", "band"])
    deeper = F.filter("own", lambda x: x["depth"] >= F.col("depth"))

    def sum_of(value: str) -> Column:
        return F.aggregate(F.transform(deeper, lambda x: x[value]), F.lit(0).cast("long"), lambda s, x: s + x)

    given = up.select(*KEY, *[sum_of(v).alias(v) for v in values])
    return stored(given.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values]), "totals")


def ends_of(paths: DataFrame) -> DataFrame:
    """Per node where conversations end the SHA-256 of their ids, ascending and joined by commas.

    Ids are sorted in ranges over (node, id) and joined to texts of at most ``IDS``
    ids there; a node's hash then takes these texts one after the other, so that
    no task holds all ids of a node.
    """
    ends = stored(paths.where("last").select(*KEY, "conv_id"), "ends")
    by = [*KEY, "conv_id"]
    sorted_ends = ends.repartitionByRange(ranges_for(ends), *by).sortWithinPartitions(*by)
    joined = sorted_ends.mapInArrow(joined_ids, f"{NODE}, first long, ids string")
    dealt = stored(joined, "ids")
    n = ranges_for(dealt)
    return dealt.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed_ids, f"{NODE}, ends_sha256 string")


def rows_in(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def in_batches(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (node, id) as texts of at most ``IDS`` ids."""

    def runs() -> Iterator[tuple]:
        node, ids = None, []
        for *own, conv in rows_in(batches):
            if ids and (own != node or len(ids) == IDS):
                yield (*node, ids[0], ",".join(map(str, ids)))
                ids = []
            node = own
            ids.append(conv)
        if ids:
            yield (*node, ids[0], ",".join(map(str, ids)))

    types = [pa.int64()] * 4 + [pa.string()]
    return in_batches(runs(), [*KEY, "first", "ids"], types, 256)


def hashed_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's texts, which come in order."""

    def hashes() -> Iterator[tuple]:
        node, seen = None, None
        for *own, _, ids in rows_in(batches):
            if own == node:
                seen.update(b",")
            else:
                if seen:
                    yield (*node, seen.hexdigest())
                node, seen = own, hashlib.sha256()
            seen.update(ids.encode())
        if seen:
            yield (*node, seen.hexdigest())

    return in_batches(hashes(), [*KEY, "ends_sha256"], [pa.int64()] * 3 + [pa.string()], 4096)


def trie(steps: DataFrame) -> DataFrame:
    """Per node of the trie of some conversations (conv_id, depth, mark, chars, last) its counts and totals.

    ``conv_id`` is the smallest member; (conv_id, depth) names the node.
    """
    paths, deepest = prefixes(steps)
    nodes = paths.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        F.min("up0").alias("up0"),
        F.min("up1").alias("up1"),
    )
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up0").alias("k0"), F.col("up1").alias("k1"))
    children = children.agg(F.count("*").alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    nodes = nodes.join(children, KEY, "left").withColumns(
        {
            "n_children": n_children,
            "n_leaves": (n_children == 0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
        }
    )
    nodes = stored(nodes, "nodes")
    found = totals(paths, nodes, deepest, ["n_leaves", "saved_tokens"])

    first = nodes.where("depth = 0").select("conv_id").first()  # the root, which would be one hot key below
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k0").alias("up0"), F.col("k1").alias("up1"), F.col("conv_id").alias("parent"))
    above = nodes.where("depth > 1").join(parents.where("depth > 1"), ["depth", "up0", "up1"])
    low = nodes.where("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(first[0] if first else None).cast("long")))
    named = above.select(*low.columns).unionByName(low).drop("n_leaves", "saved_tokens")
    ends = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return named.join(found, KEY).join(ends_of(paths), KEY, "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        ends.alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations; an empty table has no node."""
    return trie(rebuilt(turns_of(conversations)))


MARK = " || ".join(f"strlen(coalesce({c}, '')) || ':' || coalesce({c}, '')" for c in ("role", "text"))
MARK = f"sha256({MARK})"
ORACLE = f"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {MARK}) AS k,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS step
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(step ORDER BY k) AS steps,
         {sql_crc32('conv_id')} % 6 AS h
  FROM numbered GROUP BY conv_id),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.steps[1 : a.h], []), a.steps[a.h + 1 :]) AS steps
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, steps[1 : d] AS path, d = len(steps) AS last
  FROM (SELECT conv_id, steps, unnest(range(len(steps) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
  FROM prefixes GROUP BY d, path),
linked AS (
  SELECT n.*, p.conv_id AS parent, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.path[1 : n.d] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1 : n.d - 1]),
spread AS (
  SELECT unnest(range(d + 1)) AS d, path, n_children = 0 AS leaf,
         CASE WHEN d > 0 THEN (n_convs - 1) * length(path[d].text) ELSE 0 END AS saved
  FROM linked),
sums AS (
  SELECT d, path[1 : d] AS path, count(*) FILTER (leaf) AS n_leaves, sum(saved)::bigint AS saved FROM spread GROUP BY ALL)
SELECT l.conv_id, l.d AS depth, l.parent AS parent_conv_id, l.n_convs, l.n_children, s.n_leaves,
       s.saved AS saved_tokens, l.ends AS ends_sha256
FROM linked l JOIN sums s ON l.d = s.d AND l.path = s.path
"""
