"""Language-model scores: bigrams counted over the corpus, in Elias-Fano tries dealt out by word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import list_chunks, list_column, lowered, remainder, stored, whole, words
from terrace.llm.trie import Trie

#: A word with this part of all tokens, or more, is dealt out by its pairs, and a pair is scored where it stands;
#: there are no more such words and pairs.
FREQUENT = 4096
PER_SHARD = 1_200_000  # tokens of a shard, about
PRIOR = 64.0  # tokens that the word's own probability weighs against the counts of a context
TRAINED = 1 << 15
ENTRY = np.dtype([("doc", "<u2"), ("score", "<f8"), ("base", "<f8"), ("known", "<u4")])
HEAD = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("held_out", "u1"), ("n_tokens", "<i8"), ("score", "<f8"), ("base", "<f8"), ("known", "<u4")])


def tokens(docs: DataFrame, held_out: Column) -> DataFrame:
    """Hashes of each whole text's words, in order, and of the end."""
    end = F.xxhash64(F.lit(" "))  # no word has a blank
    hashes = F.transform(words(lowered(whole())), lambda w: F.xxhash64(w))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        F.concat(hashes, F.array(end)).alias("tokens"),
    )


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each chunk of texts with their numbers, in training and in all."""
    for batch in batches:
        for chunk in list_chunks(batch, "tokens", 1 << 20) if batch.num_rows else ():
            held_out = chunk.column("held_out")
            for part, trained in ((chunk.filter(pc.invert(held_out)), 1), (chunk.filter(held_out), 0)):
                if part.num_rows:
                    word, n = np.unique(list_column(part, "tokens")[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word, pa.int64()), pa.array(n * trained, pa.int64()), pa.array(n, pa.int64())],
                        names=["word", "n", "m"],
                    )


def placed(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and row of each token. A context is the upper half of the hash of the word before, 0 at the start."""
    flat, offsets = list_column(chunk, "tokens")
    word = flat.view(np.uint64)
    context = np.r_[np.zeros(1, dtype=np.uint32), (word[:-1] >> np.uint64(32)).astype(np.uint32)]
    context[offsets[:-1]] = 0
    return word, context, np.repeat(np.arange(chunk.num_rows), np.diff(offsets))


def position(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value stands in a sorted array, -1 if nowhere."""
    if not len(sorted_):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def pair_key(word_at: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One number for a frequent word's place and a context."""
    return word_at.astype(np.int64) << 32 | context.astype(np.int64)


def frequent_pairs(rows: DataFrame, frequent: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and training counts of the pairs with 1 / ``FREQUENT`` of all tokens or more, by key.

    Both words of such a pair are frequent, unless it stands at the start.
    """
    contexts = np.unique(np.r_[np.zeros(1, dtype=np.uint32), (frequent >> np.uint64(32)).astype(np.uint32)])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in list_chunks(batch, "tokens", 1 << 20) if batch.num_rows else ():
                word, context, row = placed(chunk)
                at = position(frequent, word)
                may = (at >= 0) & (position(contexts, context) >= 0)
                trained = ~chunk.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                keys, inverse = np.unique(pair_key(at[may], context[may]), return_inverse=True)
                n = np.bincount(inverse, trained[row[may]], len(keys)).astype(np.int64)
                m = np.bincount(inverse, minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, n, m)], names=["pair", "n", "m"])

    some = rows.select("tokens", "held_out").mapInArrow(count, "pair long, n long, m long").groupBy("pair")
    top = some.agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where(F.col("m") * FREQUENT >= every).toPandas()
    top = top.sort_values("pair")  # at most FREQUENT rows
    return top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def deal(
    word: np.ndarray, context: np.ndarray, doc: np.ndarray, shards: int, frequent: np.ndarray
) -> Iterator[tuple[int, bytes]]:
    """The tokens of some documents for each shard: words with their counts, contexts and documents.

    A token goes by its word, that of a frequent word by its pair.
    """
    if not len(word):
        return
    mark = scrambled(word)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
        hot = frequent[at] == word
        mark[hot] = scrambled(mark[hot] + context[hot])
    shard = (mark % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((word, shard))
    word, context, doc, shard = word[order], context[order], doc[order], shard[order]
    cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own, times = np.unique(word[a:b], return_counts=True)
        head = np.array([len(own), b - a], dtype="<u4").tobytes()
        yield int(shard[a]), head + own.tobytes() + times.astype("<u4").tobytes() + context[a:b].tobytes() + doc[a:b].tobytes()


def dealt(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, contexts and documents of what ``deal`` packed."""
    n, m = np.frombuffer(raw, "<u4", 2).tolist()
    at = 8
    own = np.frombuffer(raw, "<u8", n, at)
    times = np.frombuffer(raw, "<u4", n, at + 8 * n)
    context = np.frombuffer(raw, "<u4", m, at + 12 * n)
    doc = np.frombuffer(raw, "<u2", m, at + 12 * n + 4 * m)
    return np.repeat(own, times), context, doc


def score_shard(
    parts: list[bytes], total: int, distinct: int, frequent: np.ndarray, frequent_counts: np.ndarray
) -> list[np.ndarray]:
    """Count the trained tokens of a shard, build its trie, and score all its tokens with it.

    The probability of a word after a context is the count of the pair, plus
    ``PRIOR`` times the word's own add-one probability, over the count of the
    context plus ``PRIOR``. The logarithm falls into two parts. The first is
    looked up in the trie; the second needs only the count of the context. A
    word finds its own count here, so it gives the second part for the token
    after it, and the end gives that for the start of its text.
    """
    if not parts:
        return []
    split = [dealt(p) for p in parts]
    part = np.repeat(np.arange(len(split), dtype=np.int32), [len(s[0]) for s in split])
    word, context, doc = (np.concatenate([s[i] for s in split]) for i in range(3))
    del split
    order = np.lexsort((context, word))
    word, context, doc, part = word[order], context[order], doc[order], part[order]
    trained = (doc & TRAINED) > 0
    new_word = np.r_[True, word[1:] != word[:-1]]
    new_pair = new_word | np.r_[True, context[1:] != context[:-1]]
    at_word, at_pair = np.flatnonzero(new_word), np.flatnonzero(new_pair)
    own = word[at_word]
    count = np.add.reduceat(trained, at_word, dtype=np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        count = np.where(frequent[at] == own, frequent_counts[at], count)
    pair_count = np.add.reduceat(trained, at_pair, dtype=np.int64)
    word_of_pair = (np.cumsum(new_word) - 1)[at_pair]
    prior = PRIOR * (count + 1) / (total + distinct + 1)

    # the trie of what was seen in training here
    seen = pair_count > 0
    nodes, first = np.unique(word_of_pair[seen], return_index=True)
    trie = Trie(
        own[nodes],
        np.log10(prior[nodes]),
        first,
        context[at_pair][seen],
        np.log10(pair_count[seen] + prior[word_of_pair[seen]]),
    )
    known, hit, back, value = trie.look_up(word[at_pair], context[at_pair])
    # a word without a pair here is new, or a frequent one all of whose trained pairs lie elsewhere
    numerator = np.where(hit, value, np.where(known, back, np.log10(prior[word_of_pair])))
    pair = np.cumsum(new_pair) - 1
    of_word = np.cumsum(new_word) - 1
    score = numerator[pair] - np.log10(count + PRIOR)[of_word]
    base = np.log10(count + 1.0)[of_word]

    key = part.astype(np.int64) * TRAINED + (doc & (TRAINED - 1))
    keys, inverse = np.unique(key, return_inverse=True)
    sums = np.zeros(len(keys), dtype=ENTRY)
    sums["doc"] = keys % TRAINED
    sums["score"] = np.bincount(inverse, score, len(keys))
    sums["base"] = np.bincount(inverse, base, len(keys))
    sums["known"] = np.bincount(inverse, (count > 0)[of_word], len(keys))
    return np.split(sums, np.searchsorted(keys // TRAINED, np.arange(1, len(parts))))


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of every row of ``docs`` under a model of those that are not held out.

    Null and empty texts have the end as their only token. Rows are told apart
    by their place, so null or repeated ids do not mix. With no rows to learn
    from, every token is unknown. Words are told apart by a 64-bit hash, and
    the contexts of one word by 32 bits.
    """
    rows = tokens(docs, held_out)
    some = rows.select("tokens", "held_out").mapInArrow(counted, "word long, n long, m long")
    vocabulary = stored(some.groupBy("word").agg(F.sum("n").alias("count"), F.sum("m").alias("every")), "vocabulary")
    sums = [F.count_if(F.col("count") > 0), *[F.coalesce(F.sum(c), F.lit(0)) for c in ("count", "every")]]
    distinct, total, every = vocabulary.agg(*sums).first()
    top = vocabulary.where(F.col("every") * FREQUENT >= every).toPandas()  # at most FREQUENT rows
    frequent = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    frequent, counts = frequent[order], top["count"].to_numpy(np.int64)[order]
    pairs, pair_counts = frequent_pairs(rows, frequent, every)
    # what a shard would find for them, as their counts are known
    pair_word = counts[pairs >> 32]
    pair_prior = PRIOR * (pair_word + 1) / (total + distinct + 1)
    pair_score = np.log10(pair_counts + pair_prior) - np.log10(pair_word + PRIOR)
    shards = total // PER_SHARD + 2

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for chunk in list_chunks(batch, "tokens", 1 << 20) if batch.num_rows else ():
                where = task << 32 | number
                number += 1
                head = np.zeros(chunk.num_rows, dtype=HEAD)
                head["null"] = chunk.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                head["doc_id"] = chunk.column("doc_id").fill_null(0).to_numpy()
                head["held_out"] = chunk.column("held_out").to_numpy(zero_copy_only=False)
                head["n_tokens"] = np.diff(list_column(chunk, "tokens")[1])
                word, context, row = placed(chunk)
                at = position(frequent, word)
                pair = np.where(at >= 0, position(pairs, pair_key(np.maximum(at, 0), context)), -1)
                hot = pair >= 0
                own, own_row = pair[hot], row[hot]
                head["score"] = np.bincount(own_row, pair_score[own], chunk.num_rows)
                head["base"] = np.bincount(own_row, np.log10(pair_word[own] + 1.0), chunk.num_rows)
                head["known"] = np.bincount(own_row, pair_word[own] > 0, chunk.num_rows)
                doc = row.astype(np.uint16) | np.where(head["held_out"] > 0, 0, TRAINED).astype(np.uint16)[row]
                parts = [(where % shards, True, head.tobytes())]
                rest = deal(word[~hot], context[~hot], doc[~hot], shards, frequent)
                parts += [(shard, False, raw) for shard, raw in rest]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in parts], pa.int64()),
                        pa.array([where] * len(parts), pa.int64()),
                        pa.array([p[1] for p in parts], pa.bool_()),
                        pa.array([p[2] for p in parts], pa.binary()),
                    ],
                    names=["shard", "batch", "head", "raw"],
                )

    def in_shard(table: pa.Table) -> pa.Table:
        heads = table.filter(table["head"])
        body = table.filter(pc.invert(table["head"])) if table.num_rows else table
        found = score_shard(body["raw"].to_pylist(), total, distinct, frequent, counts)
        out = pa.table(
            {
                "batch": body["batch"],
                "head": body["head"],
                "raw": pa.array([f.tobytes() for f in found], pa.binary()),
            }
        )
        return pa.concat_tables([out, heads.select(["batch", "head", "raw"])])

    def of_batch(table: pa.Table) -> pa.Table:
        flags, raws = table["head"].to_pylist(), table["raw"].to_pylist()
        head = np.frombuffer(next(r for r, f in zip(raws, flags) if f), HEAD)
        n = len(head)
        entries = np.concatenate([np.zeros(0, ENTRY), *[np.frombuffer(r, ENTRY) for r, f in zip(raws, flags) if not f]])
        add = lambda name: head[name] + np.bincount(entries["doc"], entries[name], n)
        return pa.table(
            {
                "doc_id": pa.array(head["doc_id"], pa.int64(), mask=head["null"] > 0),
                "held_out": pa.array(head["held_out"] > 0),
                "n_tokens": pa.array(head["n_tokens"]),
                "n_known": pa.array(add("known").astype(np.int64)),
                "train_tokens": pa.array(np.full(n, total)),
                "base_score": pa.array(add("base") - head["n_tokens"] * np.log10(total + distinct + 1)),
                "score": pa.array(add("score")),
            }
        )

    spread_rows = rows.mapInArrow(spread, "shard long, batch long, head boolean, raw binary")
    sums = spread_rows.groupBy("shard").applyInArrow(in_shard, "batch long, head boolean, raw binary")
    return sums.groupBy("batch").applyInArrow(
        of_batch,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def score_documents(docs: DataFrame) -> DataFrame:
    return score(docs, remainder("doc_id", 7) == 2)
