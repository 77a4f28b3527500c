"""A Merkle manifest of a dataset: sibling-shift self-joins, level by level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.ranks import positions
from terrace.llm.text import remainder, sql_crc32, stored

FAN = 3  # nodes of a run, which have one parent
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")  # what a leaf is made of, in this order
TOP = "*"  # key of the tree over the trees


def field(value: Column) -> Column:
    """A value with its length in front: ``-`` for null, else UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """SHA-256 of some texts in a row, in lower-case hex."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def leaf_of(values: dict[str, Column]) -> Column:
    return digest(*[field(values[c]) for c in COLUMNS])


def shown(value: Column) -> Column:
    return F.lower(F.hex(value))


def slots(fan: int, at: Column) -> list[tuple[Column, Column]]:
    """For each of the other places of a node's run its index, and whether it stands before the node.

    In runs of two that is the index with its lowest bit turned, otherwise the
    node's slot shifted around within the run.
    """
    slot = at % fan
    if fan == 2:
        return [(at.bitwiseXOR(F.lit(1)), slot == 1)]
    return [(at - slot + (slot + k) % fan, slot + k >= fan) for k in range(1, fan)]


def with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes (tree, at, node, ...) with the siblings ``before`` and ``after`` them, left to right.

    One equi-join for each of the other places of a run; a place that the last
    run lacks gives nothing. Keys are unique, so no task gets many rows.
    """
    out, parts = nodes, []
    for k, (index, earlier) in enumerate(slots(fan, F.col("at"))):
        other = nodes.select(
            F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("node").alias(f"_node{k}")
        )
        out = out.join(other, (F.col("tree") == F.col("_tree")) & (index == F.col("_at")), "left").drop("_tree", "_at")
        parts.append((F.coalesce(F.col(f"_node{k}"), F.lit(b"")), earlier))
    before = F.concat(*[F.when(e, x).otherwise(F.lit(b"")) for x, e in parts])
    after = F.concat(*[F.when(e, F.lit(b"")).otherwise(x) for x, e in parts])
    return out.select(*nodes.columns, before.alias("before"), after.alias("after"))


def grow(nodes: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels of some trees, from the leaves up, and the roots that stand at each level.

    ``nodes`` has (tree, at, size, node): each tree's leaves by their index, their
    number, and their digests as bytes. A level has the nodes of the trees that are
    not down to one yet, with their siblings, and further columns of the leaves;
    the node in the first slot of each run emits the parent. Every level is a
    table. A tree of n leaves takes log(n) levels, and a lone leaf is its root.
    """
    levels, roots = [], []
    while True:
        roots.append(nodes.where("size = 1"))
        several = nodes.where("size > 1")
        if several.isEmpty():
            return levels, roots
        level = stored(with_siblings(several, fan), "level")
        levels.append(level)
        parent = F.unhex(digest(shown(F.col("node")), shown(F.col("after"))))
        nodes = stored(
            level.where(F.col("at") % fan == 0).select(
                "tree",
                F.expr(f"at div {fan}").alias("at"),
                F.expr(f"(size + {fan - 1}) div {fan}").alias("size"),
                parent.alias("node"),
            ),
            "nodes",
        )


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def paths(levels: list[DataFrame], roots: list[DataFrame], above: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves with ``path``, their siblings at each level up to the root and what ``above`` (tree, path) goes on with.

    From the root down, each node's siblings go in front of its parent's path.
    A parent has at most ``fan`` children, so a path is never sent to more.
    """
    own = F.array(F.struct("before", "after"))
    found = roots[-1].join(above, "tree")
    for k in range(len(levels) - 1, -1, -1):
        upper = stored(found.select("tree", F.col("at").alias("_at"), "path"), "paths").withColumnRenamed("tree", "_tree")
        same = (F.col("tree") == F.col("_tree")) & (F.expr(f"at div {fan}") == F.col("_at"))
        joined = levels[k].join(upper, same)
        found = joined.select(*roots[k].columns, F.concat(own, F.col("path")).alias("path"))
        found = found.unionByName(roots[k].join(above, "tree"))
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest (hex) leads to along a path."""
    return F.aggregate(path, leaf, lambda h, step: digest(shown(step["before"]), h, shown(step["after"])))


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """Per row of ``docs`` its leaf, the root of its source's tree, the root over all sources, and its path.

    Leaves stand in the order of doc_id (nulls first), those of one doc_id in the
    order of their digests; sources in the order of their bytes, null first and as
    a source of its own. ``altered`` names columns that have been changed since:
    ``altered`` in the result is the leaf of the changed row. Equal rows are so
    many leaves; texts may be empty, null or of any length; an empty table gives
    an empty manifest. Columns that a leaf is not made of are not looked at.
    """
    values = {c: F.col(c) for c in COLUMNS}
    source = F.col("source").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_of(values)).alias("node"),
        F.unhex(leaf_of(values | (altered or {}))).alias("altered"),
    )
    leaves = positions(rows, "tree", ["doc_id", "node"])
    levels, roots = grow(leaves, fan)
    subroots = stored(union([r.select("tree", "node") for r in roots]), "subroots")

    tops = positions(subroots.select(F.lit(TOP).alias("all"), F.col("tree").alias("doc_id"), "node"), "all", ["doc_id"])
    tops = tops.select(F.col("all").alias("tree"), "doc_id", "node", "at", "size")
    top_levels, top_roots = grow(tops, fan)
    none = F.array().cast("array<struct<before:binary,after:binary>>")
    top = top_roots[-1].select("tree", none.alias("path"))
    sources = paths(top_levels, top_roots, top, fan)
    above = stored(sources.select(F.col("doc_id").alias("tree"), "path"), "above")

    placed = paths(levels, roots, above, fan)
    root = top_roots[-1].select(shown(F.col("node"))).first()  # one digest
    ends = subroots.select("tree", shown(F.col("node")).alias("subroot"))
    return placed.join(ends, "tree").select(
        "doc_id",
        F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("source"),
        shown(F.col("node")).alias("leaf"),
        shown(F.col("altered")).alias("altered"),
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        "path",
    )


def verify(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof digest of every row, and whether its leaf, in part tampered with, still leads to the root.

    Where the crc32 of doc_id (null: of the empty text) is even, the line ends are
    taken out of the text; that changes nothing where there are none.
    """
    less = F.when(remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    siblings = F.transform("path", lambda s: F.concat(shown(s["before"]), shown(s["after"])))
    found = manifest(docs, {"text": less})
    back = found.withColumn("folded_root", folded(F.col("altered"), F.col("path")))
    return back.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE = f"""
WITH RECURSIVE shown AS (
  SELECT doc_id, source, lang, n_chars, text,
         coalesce({sql_crc32('doc_id')}, 0) % 2 = 0 AS cut
  FROM documents),
made AS (
  SELECT doc_id, source,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS front,
         text, CASE WHEN cut THEN replace(text, chr(10), '') ELSE text END AS less
  FROM shown),
leaves AS (
  SELECT doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(front || coalesce(strlen(less) || ':' || less, '-')) AS changed FROM made),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, source, i, n, leaf AS node FROM placed
  UNION ALL
  SELECT level + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY level, source, i // 3, n),
subroots AS (
  SELECT source, level, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, node FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY i))
  FROM tops WHERE n > 1 GROUP BY level, i // 3, n),
beside AS (
  SELECT a.level, a.source, a.i,
         coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY ALL),
beside_top AS (
  SELECT a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM tops a JOIN tops b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL),
steps AS (
  SELECT p.source, p.i AS leaf_i, b.level, b.before, b.after
  FROM placed p JOIN beside b ON p.source IS NOT DISTINCT FROM b.source
       AND p.i // (3 ** b.level)::bigint = b.i
  UNION ALL
  SELECT p.source, p.i, s.level + b.level, b.before, b.after
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
       JOIN beside_top b ON s.i // (3 ** b.level)::bigint = b.i),
folded AS (
  SELECT source, i AS leaf_i, 0 AS level, changed AS h FROM placed
  UNION ALL
  SELECT f.source, f.leaf_i, f.level + 1, sha256(s.before || f.h || s.after)
  FROM folded f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.leaf_i = s.leaf_i AND f.level = s.level),
ends AS (
  SELECT source, leaf_i, arg_max(h, level) AS folded_root FROM folded GROUP BY ALL),
proofs AS (
  SELECT source, leaf_i, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM steps GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.node AS subroot, t.node AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.node AS verified
FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
JOIN (SELECT node FROM tops WHERE n = 1) t ON true
JOIN ends e ON p.source IS NOT DISTINCT FROM e.source AND p.i = e.leaf_i
LEFT JOIN proofs q ON p.source IS NOT DISTINCT FROM q.source AND p.i = q.leaf_i
"""
