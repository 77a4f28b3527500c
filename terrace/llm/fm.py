"""Quality classifier: a factorisation machine over hashed words, shape and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.stats import SHARES, statistics
from terrace.llm.text import list_chunks, list_column, lowered, remainder, whole, words

BUCKETS = 1 << 15
FACTORS = 8
MAX_TRAIN = 8_000  # labelled rows the model is fitted on, those with the smallest hash of doc_id
EPOCHS, STEPS = 6, 300  # passes over the training rows, more of them until there are so many steps
BATCH = 256
CUT = 0.3
DENSE = (*SHARES, "log_chars", "log_words")


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """Word buckets and dense statistics of each whole text, beside some columns.

    The metadata is the length in code points, taken from the text itself, as
    the column of that name may be null or stale. Words are those of the text in
    lower case, here and in the statistics, so that it is split once.
    """

    def buckets(hashes: Column) -> Column:
        return F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))

    wide = statistics(
        docs.select(*keep, "text", F.length(whole()).alias("__chars")),
        *keep,
        "__chars",
        tokens=lambda text: words(lowered(text)),
        more={"__buckets": buckets},
    )
    dense = [F.col(c).cast("double") for c in SHARES]
    dense += [F.log1p(F.col("__chars").cast("double")), F.log1p(F.col("n_words").cast("double"))]
    return wide.select(*keep, F.col("__buckets").alias("buckets"), F.array(*dense).alias("dense"))


@dataclass
class Rows:
    """Sparse rows: feature ``index`` and ``value`` of each entry, row starts, in CSR form."""

    index: np.ndarray
    value: np.ndarray
    start: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.start)[rows]
        starts = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(self.start[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(self.index[at], self.value[at], starts)

    def sums(self, per_entry: np.ndarray) -> np.ndarray:
        """Sums over the entries of each row; every row has some, its dense ones."""
        return np.add.reduceat(per_entry, self.start[:-1], axis=0)


def sparse(buckets: np.ndarray, offsets: np.ndarray, dense: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Rows:
    """Rows of the model: log counts of word buckets, scaled to length 1, then the dense statistics."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    keys, times = np.unique(row * BUCKETS + buckets, return_counts=True)
    own, index = keys // BUCKETS, keys % BUCKETS
    value = np.log1p(times)
    norm = np.sqrt(np.bincount(own, value**2, minlength=n))
    value = value / norm[own]
    shape = np.clip((dense - mean) / scale, -4, 4)
    k = dense.shape[1]
    own = np.r_[own, np.repeat(np.arange(n), k)]
    index = np.r_[index, np.tile(BUCKETS + np.arange(k), n)]
    value = np.r_[value, shape.ravel()]
    order = np.argsort(own, kind="stable")
    return Rows(index[order], value[order], np.searchsorted(own[order], np.arange(n + 1)))


@dataclass
class Machine:
    """score = sigmoid(bias + w.x + sum of <v_i, v_j> x_i x_j over all pairs i < j)."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def margin(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and the factor sums of each row.

        All pairs in linear time: half of the square of the sum, less the sum of the squares.
        """
        vx = self.factor[rows.index] * rows.value[:, None]
        total = rows.sums(vx)
        pairs = 0.5 * (total**2 - rows.sums(vx**2)).sum(axis=1)
        return self.bias + rows.sums(self.weight[rows.index] * rows.value) + pairs, total

    def score(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows)[0], -30, 30)))


def fit(buckets: np.ndarray, offsets: np.ndarray, dense: np.ndarray, label: np.ndarray) -> Machine:
    """Logistic loss, AdaGrad, fixed seed; without rows of both labels a constant is learned."""
    n, k = len(label), len(DENSE)
    mean = dense.mean(axis=0) if n else np.zeros(k)
    scale = np.maximum(dense.std(axis=0), 1e-6) if n else np.ones(k)
    size = BUCKETS + k
    rng = np.random.default_rng(7)
    good = label.sum() if n else 0
    model = Machine(float(np.log((good + 1) / (n - good + 1))), np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)), mean, scale)
    if not n or good in (0, n):
        model.factor[:] = 0
        return model
    rows = sparse(buckets, offsets, dense, mean, scale)
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(n, BATCH)))):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            some = order[at : at + BATCH]
            part = rows.take(some)
            margin, total = model.margin(part)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[some]) / len(some)
            e = np.repeat(error, np.diff(part.start))
            x, index = part.value, part.index
            g = np.bincount(index, e * x, minlength=size) + 1e-6 * model.weight
            own = np.repeat(total, np.diff(part.start), axis=0) - model.factor[index] * x[:, None]
            gv = own * (e * x)[:, None]
            gv = np.stack([np.bincount(index, gv[:, f], minlength=size) for f in range(FACTORS)], axis=1)
            seen_w += g**2
            seen_v += gv**2
            seen_b += error.sum() ** 2
            model.weight -= 0.1 * g / np.sqrt(seen_w)
            model.factor -= 0.02 * gv / np.sqrt(seen_v)
            model.bias -= 0.1 * error.sum() / np.sqrt(seen_b)
    return model


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on at most ``MAX_TRAIN`` labelled rows of ``docs`` that are not held out.

    Rows without doc_id or label say nothing. The sample is the same in every run.
    """
    marks = labels.where(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 1).cast("int").alias("label"))
    marks = marks.where(remainder("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(MAX_TRAIN)
    sample = features(docs.join(F.broadcast(marks), "doc_id"), "doc_id", "label")
    got = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.hash("buckets")).limit(MAX_TRAIN).toArrow()
    if not got.num_rows:
        none = np.empty(0, dtype=np.int64)
        return fit(none, np.zeros(1, dtype=np.int64), np.empty((0, len(DENSE))), none)
    batch = got.combine_chunks().to_batches()[0]
    buckets, offsets = list_column(batch, "buckets")
    dense = list_column(batch, "dense")[0].reshape(-1, len(DENSE))
    return fit(buckets, offsets, dense, batch.column("label").to_numpy().astype(float))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: whether it is held out, its score, and the verdict.

    The score depends on the text alone. Null texts count as empty; a null
    doc_id is held out if the empty text is.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(keyed, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BUCKETS and FACTORS

    def score(batches):
        machine = shared.value
        for batch in batches:
            for part in list_chunks(batch, "buckets"):
                buckets, offsets = list_column(part, "buckets")
                dense = list_column(part, "dense")[0].reshape(-1, len(DENSE))
                scores = machine.score(sparse(buckets, offsets, dense, machine.mean, machine.scale))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    rows = features(keyed.withColumn("held_out", remainder("doc_id", 5) == 0), "doc_id", "held_out")
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", predicted(F.col("score")))


def predicted(score: Column) -> Column:
    return (score >= CUT).cast("int")
