"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.text import over_chunks, stored, text_chunks, whole
from terrace.session import MAX_SHUFFLE_PARTITIONS, input_bytes

CELLS = 12  # of a fingerprint; a retry has GROWTH times as many as the try before
GROWTH = 4
HASHES = 3  # each has a part of the cells for itself
#: A paragraph is a line; it is broken at the ends of sentences, and where ``pieces`` cuts what has none for long.
PARAGRAPH = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
LONG, LEAST, MOST = 400, 64, 4096  # characters: of what is cut, and of a piece
WINDOW, EVERY = 8, 256  # characters that decide on a cut, and one in how many places is one
RANGE = 32 << 20  # bytes of input in a range of documents, about
SAMPLE = 64  # places for each range that its bounds are found from


def pieces(run: str) -> list[str]:
    """A long run cut where the characters before say so, so that what is put in moves few cuts."""
    points = mixed(np.frombuffer(run.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64), 7)
    sums = np.r_[np.zeros(1, dtype=np.uint64), np.cumsum(points, dtype=np.uint64)]
    rolled = mixed(sums[WINDOW:] - sums[:-WINDOW], 8)
    out, start = [], 0
    for cut in (np.flatnonzero(rolled % np.uint64(EVERY) == 0) + WINDOW).tolist() + [len(run)]:
        while cut - start > MOST:
            out.append(run[start : start + MOST])
            start += MOST
        if cut - start >= LEAST or cut == len(run):
            out.append(run[start:cut])
            start = cut
    return out


def paragraphs(text: str) -> Iterator[str]:
    for part in PARAGRAPH.findall(text):
        yield from pieces(part) if len(part) > LONG else (part,)


def digests(text: str) -> np.ndarray:
    """64-bit digests of the paragraphs of a text; the n-th repeat of one has a digest of its own."""
    seen: dict[str, int] = {}
    out = []
    for part in paragraphs(text):
        part = part.strip()
        if part:
            n = seen.get(part, 0)
            seen[part] = n + 1
            out.append(xxhash.xxh64_intdigest(part, n))
    return np.array(out, dtype=np.uint64)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys scrambled anew for each seed."""
    x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sketches:
    """Sketches of ``n`` sets, side by side: per cell a count, and the xor of keys and of checks."""

    def __init__(self, n: int, cells: int):
        self.cells = cells
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.key = np.zeros(n * cells, dtype=np.uint64)
        self.check = np.zeros(n * cells, dtype=np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> np.ndarray:
        """Put keys in, or take them out; returns the cells touched."""
        part = self.cells // HASHES
        check = mixed(keys, 99)
        at = []
        for j in range(HASHES):
            cell = owner * self.cells + j * part + (mixed(keys, j + self.cells) % np.uint64(part)).astype(np.int64)
            np.add.at(self.count, cell, sign)
            np.bitwise_xor.at(self.key, cell, keys)
            np.bitwise_xor.at(self.check, cell, check)
            at.append(cell)
        return np.concatenate(at)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells)
        out.count = self.count - other.count
        out.key = self.key ^ other.key
        out.check = self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take out pure cells until none is left.

        Returns owners, keys and signs of what was recovered, and which owners
        still have something that could not be.
        """
        owners, keys, signs = [], [], []
        look = np.flatnonzero(self.count)
        while len(look):
            pure = look[(np.abs(self.count[look]) == 1) & (mixed(self.key[look], 99) == self.check[look])]
            if not len(pure):
                break
            owner, key, sign = pure // self.cells, self.key[pure], self.count[pure]
            order = np.lexsort((key, owner))  # a key may be alone in several of its cells
            owner, key, sign = owner[order], key[order], sign[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]
            owner, key, sign = owner[new], key[new], sign[new]
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            look = np.unique(self.add(owner, key, -sign))
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        stuck = left.reshape(-1, self.cells).any(axis=1)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        return join(owners, np.int64), join(keys, np.uint64), join(signs, np.int64), stuck

    def texts(self, sizes: np.ndarray) -> list[str]:
        """Each sketch as text: the number of its paragraphs and its cells."""
        n = len(sizes)
        raw = np.concatenate(
            [
                self.count.astype("<u2").view(np.uint8).reshape(n, -1),
                self.key.astype("<u8").view(np.uint8).reshape(n, -1),
                self.check.astype("<u4").view(np.uint8).reshape(n, -1),
            ],
            axis=1,
        )
        return [f"{size}:{base64.b64encode(row.tobytes()).decode()}" for size, row in zip(sizes.tolist(), raw)]


def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    keys = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    return np.repeat(np.arange(len(sets)), sizes), keys, sizes


def sketches(sets: list[np.ndarray], cells: int = CELLS) -> Sketches:
    out = Sketches(len(sets), cells)
    owner, keys, _ = flat(sets)
    out.add(owner, keys, 1)
    return out


def differences(old: list[np.ndarray], new: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each pair of sets the keys of the first alone, of the second alone, and the cells it took.

    Sketches of a pair are subtracted and peeled; pairs that cannot be peeled
    are sketched again with more cells, under other hashes.
    """
    out: list = [None] * len(old)
    todo, cells = np.arange(len(old)), CELLS
    while len(todo):
        a, b = sketches([old[i] for i in todo], cells), sketches([new[i] for i in todo], cells)
        owner, key, sign, stuck = a.minus(b).peel()
        order = np.argsort(owner, kind="stable")
        owner, key, sign = owner[order], key[order], sign[order]
        ends = np.searchsorted(owner, np.arange(len(todo) + 1))
        for k in np.flatnonzero(~stuck).tolist():
            x, s = key[ends[k] : ends[k + 1]], sign[ends[k] : ends[k + 1]]
            out[todo[k]] = x[s > 0], x[s < 0], cells
        todo, cells = todo[stuck], cells * GROWTH
    return out


def likeness(old: list[np.ndarray], new: list[np.ndarray]) -> list[float]:
    """Shared paragraphs among all paragraphs of each pair; 1 for two texts without any."""
    out = []
    for a, b, (x, y, _) in zip(old, new, differences(old, new)):
        every = len(a) + len(y)
        out.append((len(a) - len(x)) / every if every else 1.0)
    return out


def compare(pairs: DataFrame, old: str, new: str) -> DataFrame:
    """Columns of ``pairs`` with the paragraph digests that only the old or only the new text has.

    ``cells`` is the size of the sketches that could be peeled. Null counts as
    empty. Input columns of the same names as those added are replaced.
    """
    added = ("only_old", "only_new", "likeness", "cells")
    kept = [F.col(f"`{c}`") for c in pairs.columns if c.lower() not in added]
    df = pairs.select(F.struct(*kept).alias("row"), whole(old).alias("old"), whole(new).alias("new"))
    empty = F.array().cast("array<long>")
    blank = dict(zip(added, (empty, empty, F.lit(0.0), F.lit(0))))
    schema = df.select("row", *[x.alias(c) for c, x in blank.items()]).schema

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        a = [digests(t) for t in chunk.column("old").to_pylist()]
        b = [digests(t) for t in chunk.column("new").to_pylist()]
        found = differences(a, b)
        signed = lambda x: np.sort(x).view(np.int64)
        columns = [chunk.column("row")]
        columns += [pa.array([signed(f[i]) for f in found], pa.list_(pa.int64())) for i in (0, 1)]
        columns += [pa.array(likeness(a, b), pa.float64()), pa.array([f[2] for f in found], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["row", *added])

    return df.mapInArrow(over_chunks(work, "old"), schema).select("row.*", *added)


def place_of(row_id: Column, mark: Column) -> Column:
    """A text whose order is that of doc_id (null below all), then of the text's digest."""
    flipped = F.hex(row_id.bitwiseXOR(F.lit(-(1 << 63))))  # negative numbers below the others
    return F.concat(F.coalesce(F.concat(F.lit("1"), F.lpad(flipped, 16, "0")), F.lpad(F.lit(""), 17, "0")), mark)


def bounds_of(rows: DataFrame, n: int) -> np.ndarray:
    """Places that cut rows into about ``n`` ranges, from a sample of about ``SAMPLE`` places for each."""
    total = rows.count()
    every = max(1, total // (SAMPLE * n))
    some = rows.where(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).select("place").distinct()
    found = np.sort(some.toPandas()["place"].to_numpy().astype("S49"))  # at most some million places
    return np.unique(found[np.arange(1, n) * len(found) // n]) if len(found) else found


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows of ``docs`` dealt into ranges of falling doc_id, each with the first row of the range after it.

    Null ids come last; rows with the same id are in the order of their texts'
    digests, and may be in many ranges. Ranges are as many as the bytes of the
    input ask for, cut at quantiles of a sample. The row put at the end of a
    range has ``tail`` set; after the last range comes the first.
    """
    spark = docs.sparkSession
    n = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), (input_bytes(docs) or 0) // RANGE)
    n = min(n, MAX_SHUFFLE_PARTITIONS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    rows = rows.withColumn("place", place_of(F.col("doc_id"), F.md5(F.col("text").cast("binary"))))
    bounds = spark.sparkContext.broadcast(bounds_of(rows, n))  # n places of 49 bytes

    @F.pandas_udf("long")
    def number(place: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds.value, place.to_numpy().astype("S49"), side="right")
        return pd.Series(len(bounds.value) - at)

    rows = rows.withColumn("range", number("place"))
    heads = stored(rows.groupBy("range").agg(F.max(F.struct("place", "doc_id", "text")).alias("head")), "heads")
    by_range, all_ranges = Window.orderBy("range"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    after = F.coalesce(F.lead("range").over(by_range), F.first("range").over(all_ranges))
    following = heads.select("range").select("range", after.alias("after"))  # numbers alone
    heads = heads.select(F.col("range").alias("after"), "head.place", "head.doc_id", "head.text")
    tails = following.join(heads, "after").select("range", F.lit(True).alias("tail"), "place", "doc_id", "text")
    dealt = rows.select("range", F.lit(False).alias("tail"), "place", "doc_id", "text").unionByName(tails)
    order = ("range", "tail", F.desc("place"))
    return dealt.repartition(n, "range").sortWithinPartitions(*order).select("range", "tail", "doc_id", "text"), n


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they and the next one's are.

    The edit puts the start of the next document (by falling doc_id; the first
    after the last) in the place of the last third. Null texts count as empty.
    """
    rows, _ = with_next(docs)
    names = [
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    ]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, str, np.ndarray, str, np.ndarray]]]:
        """Chunks of rows with the one that follows in their range."""
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for chunk in text_chunks(batch, "text"):
                out = []
                for where, tail, i, text in zip(*(chunk.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text"))):
                    own = digests(text)
                    if before is not None and before[0] == where:
                        out.append((*before[1:], text, own))
                    before = None if tail else (where, i, text, own)
                yield out

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in pairs(batches):
            if not rows:
                continue
            ids, texts, own, following, next_sets = map(list, zip(*rows))
            edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following)]
            edited_sets = [digests(t) for t in edited]
            size = lambda sets: np.fromiter(map(len, sets), np.int64, len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    pa.array(sketches(own).texts(size(own)), pa.string()),
                    pa.array(sketches(edited_sets).texts(size(edited_sets)), pa.string()),
                    pa.array(likeness(own, edited_sets), pa.float64()),
                    pa.array(likeness(own, next_sets), pa.float64()),
                ],
                names=names,
            )

    return rows.mapInArrow(work, schema)
