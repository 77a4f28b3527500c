"""Line dedup: chunks of lines that stand earlier in the corpus, whose ends rolling line hashes tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.text import let, running, stored, whole, words

LEAST = 50  # words of a chunk that is removed, and of a line that counts without its neighbours
NONE = 1 << 62  # stands for a null doc_id in the order of documents


def units(text: Column) -> Column:
    """What is counted of a text: (pos, digest) of its line pairs, and of its long lines.

    The hashes of two lines in a row are rolled into one. It does not depend on
    what stands around them, so a passage has the same ones wherever it
    stands. Long lines (told by their blanks) count alone, too. A pair's pos is twice
    its first line, a long line's one more than that.
    """

    def of(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.xxhash64(x))
        long = F.filter(
            F.transform(lines, lambda x, i: F.when(F.length(x) - F.length(F.translate(x, " ", "")) >= LEAST - 1, i)),
            lambda i: i.isNotNull(),
        )
        return F.concat(let(hashes, pairs), let(hashes, lambda h: F.transform(long, lambda i: alone(h, i))))

    def pairs(h: Column) -> Column:
        rolled = F.transform(h, lambda x, i: F.struct((2 * i).alias("pos"), F.xxhash64(x, F.get(h, i + 1)).alias("digest")))
        return F.slice(rolled, 1, F.size(h) - 1)

    def alone(h: Column, i: Column) -> Column:
        return F.struct((2 * i + 1).alias("pos"), F.get(h, i).alias("digest"))

    return let(F.split(text, "\n"), of)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of doc_id and text; rows alike in both are one document."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), whole()).cast("binary"))
    return docs.withColumn("__key", F.unhex(key))


def again(rows: DataFrame) -> DataFrame:
    """For each document the parts that seem to stand earlier, as (from, n, text): first line, lines, the earlier text.

    Units are counted by digest over all documents. The first by doc_id (null
    last), key and place stays; the others are later ones. Later pairs in a row
    whose first places are in a row, too, make one part, whose earlier text is
    sent once. Hot digests shrink in partial aggregates, and joins have one row
    per digest or document in a table on one side, so that Spark can split the other.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE)).alias("doc")
    found = rows.select("__key", doc, F.explode(units(whole())).alias("u"))
    found = stored(found.select("__key", "doc", F.col("u.pos").alias("pos"), F.col("u.digest").alias("digest")), "units")
    place = F.struct("doc", "__key", "pos")
    single = (F.col("pos") % 2 == 1).alias("single")
    ranges = found.groupBy("digest", single).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = stored(ranges.where("first <> last").select("digest", "single", "first"), "firsts")
    later = found.withColumn("single", single).join(firsts, ["digest", "single"]).where(place != F.col("first"))
    later = later.select(
        "__key",
        "single",
        F.shiftright("pos", 1).alias("pos"),
        F.col("first.__key").alias("source"),
        F.shiftright("first.pos", 1).alias("at"),
    ).distinct()
    row = Window.partitionBy("__key", "single", "source", F.col("pos") - F.col("at")).orderBy("pos")
    begins = F.coalesce(F.col("pos") - F.lag("pos").over(row) > 1, F.lit(True))
    run = later.withColumn("run", F.sum(begins.cast("int")).over(row))
    parts = run.groupBy("__key", "single", "source", (F.col("pos") - F.col("at")).alias("by"), "run").agg(
        F.min("pos").alias("from"), (F.max("pos") - F.min("pos") + F.when(F.col("single"), 1).otherwise(2)).alias("n")
    )
    parts = stored(parts.select("__key", "source", "from", (F.col("from") - F.col("by")).alias("at"), "n"), "parts")
    # the keys of sources grow with the corpus: a few of them are not broadcast either, so that the plan is one at any size
    wanted = parts.select("source").distinct().hint("merge")
    texts = rows.select(F.col("__key").alias("source"), whole().alias("text")).join(wanted, "source", "left_semi")
    sources = stored(texts.dropDuplicates(["source"]), "sources")
    slices = parts.join(sources, "source").select(
        "__key", "from", "n", F.array_join(F.slice(F.split("text", "\n"), F.col("at") + 1, F.col("n")), "\n").alias("text")
    )
    return slices.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("from", "n", "text"))).alias("__again"))


def marks(lines: Column, parts: Column) -> Column:
    """A text with a 1 for each line that is in one of the parts, byte by byte, and a 0 for each other one."""
    same = F.filter(parts, lambda p: F.array_join(F.slice(lines, p["from"] + 1, p["n"]), "\n") == p["text"])

    def add(done: Column, p: Column) -> Column:
        end = p["from"] + p["n"]
        gap = F.greatest(F.lit(0), p["from"] - done["end"])
        more = F.greatest(F.lit(0), end - F.greatest(done["end"], p["from"]))
        return F.struct(
            F.greatest(done["end"], end).alias("end"),
            F.concat(done["text"], F.repeat(F.lit("0"), gap), F.repeat(F.lit("1"), more)).alias("text"),
        )

    covered = F.aggregate(same, F.struct(F.lit(0).alias("end"), F.lit("").alias("text")), add)["text"]
    return F.rpad(covered, F.size(lines), "0")


def without(lines: Column, parts: Column) -> Column:
    """What remains of a text's lines, and the numbers of chunks found and removed.

    A chunk is a row of lines each of which is in a repeated part. It goes if it has
    ``LEAST`` words or more.
    """

    def of(runs: Column) -> Column:
        ends = running(F.transform(runs, lambda r: F.length(r)))
        return let(ends, lambda e: of_ends(runs, e))

    def of_ends(runs: Column, ends: Column) -> Column:
        def piece(run: Column, i: Column) -> Column:
            own = F.slice(lines, F.get(ends, i) - F.length(run) + 1, F.length(run))
            chunk = run.startswith("1")
            return F.struct(
                own.alias("lines"),
                chunk.alias("chunk"),
                (chunk & (F.size(words(F.array_join(own, "\n"))) >= LEAST)).alias("gone"),
            )

        return let(F.transform(runs, piece), result)

    def result(pieces: Column) -> Column:
        left = F.filter(pieces, lambda p: ~p["gone"])
        return F.struct(
            F.array_join(F.flatten(F.transform(left, lambda p: p["lines"])), "\n").alias("text"),
            F.size(F.filter(pieces, lambda p: p["chunk"])).alias("n"),
            F.size(F.filter(pieces, lambda p: p["gone"])).alias("removed"),
        )

    return let(F.regexp_extract_all(marks(lines, parts), F.lit("(0+|1+)"), F.lit(1)), of)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that remain, and beside them the numbers of repeated chunks and of those removed.

    A chunk is a maximal row of lines in which each pair of neighbours, or a line of
    ``LEAST`` words alone, stands earlier in the corpus; it is removed if it has
    ``LEAST`` words. So the earliest copy of every line stays. Null texts stay null.
    A document of which nothing remains has an empty text; no row is dropped. Rows
    with the same doc_id and text are treated alike. Very long texts are
    treated whole, a table without rows gives none. All other columns stay as
    they are, but for those named like the added ones.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_chunks", "n_removed")])
    rows = keyed(docs)
    joined = rows.join(again(rows), "__key", "left")
    untouched = F.struct(F.col("text").cast("string").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("removed"))
    left = let(F.split(whole(), "\n"), lambda x: without(x, F.col("__again")))
    out = joined.withColumn("__out", F.when(F.col("__again").isNull(), untouched).otherwise(left))
    return out.select(
        *[F.col("__out.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col("__out.n").alias("n_chunks"),
        F.col("__out.removed").alias("n_removed"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """Per row: repeated chunks, how many of them were removed, and length and digest of what remains.

    Null and empty texts have none; rows that repeat are treated alike, no rows give no rows.
    """
    left = dedup(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    text = whole()
    return left.select(
        "doc_id",
        F.col("n_chunks").cast("long").alias("n_chunks"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.length(text).cast("long").alias("n_chars"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS k FROM documents),
split AS (SELECT k, doc_id, string_split(text, chr(10)) AS ls FROM (SELECT DISTINCT * FROM d)),
line AS (SELECT k, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM split),
pair AS (SELECT *, lead(l) OVER (PARTITION BY k ORDER BY i) AS after,
                length(l) - length(replace(l, ' ', '')) >= 49 AS long FROM line),
nth AS (SELECT *, after IS NOT NULL AND
               row_number() OVER (PARTITION BY l, after ORDER BY doc_id NULLS LAST, k, i) > 1 AS twice,
               row_number() OVER (PARTITION BY l ORDER BY doc_id NULLS LAST, k, i) > 1 AND long AS alone FROM pair),
mark AS (SELECT *, twice OR alone OR coalesce(lag(twice) OVER (PARTITION BY k ORDER BY i), false) AS m FROM nth),
step AS (SELECT *, (m IS DISTINCT FROM lag(m) OVER (PARTITION BY k ORDER BY i))::INT AS s FROM mark),
run AS (SELECT *, sum(s) OVER (PARTITION BY k ORDER BY i) AS r FROM step),
chunk AS (SELECT k, r, m, string_agg(l, chr(10) ORDER BY i) AS t FROM run GROUP BY ALL),
judged AS (SELECT *, m AND len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= 50 AS gone FROM chunk),
result AS (SELECT k, count(*) FILTER (m) AS n_chunks, count(*) FILTER (gone) AS n_removed,
                  coalesce(string_agg(t, chr(10) ORDER BY r) FILTER (NOT gone), '') AS left_over
           FROM judged GROUP BY k)
SELECT doc_id, n_chunks, n_removed, length(left_over)::BIGINT AS n_chars, sha256(left_over) AS text_sha256
FROM d JOIN result USING (k)
"""
