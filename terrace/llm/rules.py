"""Learned decision lists: sequential covering over labelled statistics, emitted as conditions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.stats import SHARES, statistics
from terrace.llm.text import stored

BINS = 24  # thresholds tried for each statistic
MAX_CONDITIONS = 4
MIN_COVER = 5  # rejected rows of the pruning part that a rule must find
MIN_PRECISION = 0.9


@dataclass(frozen=True)
class Condition:
    """``feature`` above ``bound``, or at most ``bound``."""

    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        x = F.col(self.feature).cast("double")
        return x > F.lit(self.bound) if self.above else x <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(Column.__and__, [c.column() for c in rule])


def verdict(rules: list[Rule]) -> Column:
    """False for rows that a rule rejects, in order; true for all others."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(holds(rule), F.lit(False)).otherwise(out)
    return out


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    at = [i / BINS for i in range(1, BINS)]
    aggregates = [F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f) for f in SHARES]
    found = rows.agg(*aggregates).first()
    return {f: sorted({float(x) for x in found[f] or []}) for f in SHARES}


def binned(rows: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """Each statistic with the number of its thresholds that lie below it, as (feature, bin) rows."""

    def below(feature: str, at: list[float]) -> Column:
        x = F.col(feature).cast("double")
        return F.size(F.filter(F.array(*map(F.lit, at)), lambda t: t < x))

    bins = [
        F.struct(F.lit(f).alias("feature"), below(f, at).alias("bin")) for f, at in bounds.items() if at
    ]
    return rows.select("bad", F.explode(F.array(*bins)).alias("b")).select("bad", "b.feature", "b.bin")


def grow(rows: DataFrame, bounds: dict[str, list[float]]) -> Rule:
    """Add the condition of the highest information gain until no good row is covered.

    Each step is one aggregation into a histogram of all statistics, whose size
    depends on the number of thresholds alone.
    """
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        covered = rows.where(holds(rule)) if rule else rows
        cells = binned(covered, bounds).groupBy("feature", "bin").agg(
            F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")
        )
        table: dict[str, dict[int, tuple[int, int]]] = {}
        for r in cells.collect():
            table.setdefault(r["feature"], {})[r["bin"]] = r["bad"], r["good"]
        if not table:
            break
        bad, good = map(sum, zip(*next(iter(table.values())).values()))
        if not bad or not good:
            break
        best, gain = None, 1e-9
        for feature in sorted(table):
            below = [0, 0]
            for i, bound in enumerate(bounds[feature]):
                x, y = table[feature].get(i, (0, 0))
                below = [below[0] + x, below[1] + y]
                for above in (True, False):
                    p, n = (bad - below[0], good - below[1]) if above else below
                    if not p or (p, n) == (bad, good):
                        continue
                    new = p * (log2(p / (p + n)) - log2(bad / (bad + good)))
                    if new > gain:
                        best, gain = Condition(feature, above, bound), new
        if best is None:
            break
        rule = (*rule, best)
    return rule


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The first conditions of a rule with the best worth on rows it was not grown on."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = holds(rule[:k])
        sums += [F.count_if(hit & (F.col("bad") == 1)), F.count_if(hit & (F.col("bad") == 0))]
    found = list(rows.agg(*sums).first())
    worth = [((p - n) / (p + n) if p + n else -1.0, p, n) for p, n in zip(found[::2], found[1::2])]
    k = max(range(len(rule)), key=lambda i: (worth[i][0], worth[i][1], -i))
    return rule[: k + 1], worth[k][1], worth[k][2]


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """An ordered list of rules that reject rows of quality 0.

    ``stats`` has ``doc_id`` and the statistics, ``labels`` has ``doc_id`` and
    ``quality``. All labelled rows take part: two thirds by the hash of doc_id
    grow the rules, the rest prunes them and decides whether they are good
    enough. Rows without a doc_id or a label say nothing; a row labelled twice
    counts twice. Without labels of both kinds the list is empty.
    """
    marks = labels.where(F.col("quality").isNotNull()).select(
        F.col("doc_id"), (F.col("quality") == 0).cast("int").alias("bad")
    )
    rows = stored(stats.select("doc_id", *SHARES).join(marks, "doc_id"), "labelled")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    bounds, rules, left = thresholds(rows), [], rows
    while any(bounds.values()):
        rule = grow(left.where(part != 0), bounds)
        if not rule:
            break
        rule, p, n = prune(left.where(part == 0), rule)
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left = left.where(~holds(rule))
    return rules


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every row of ``docs``, whether the base rules fail it, and whether it is kept.

    The statistics are written once; learning and judging read them. Rows are
    judged one by one, so null or repeated ids and texts change nothing.
    """
    stats = stored(statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id"), "stats")
    rules = learn(stats, labels)
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor the learned ones reject.

    Statistics are computed once and written beside the rows; learning reads
    the statistics alone. An empty table gives an empty one.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    judged = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    stats = stored(statistics(judged, "__row", "doc_id"), "stats")
    rules = learn(stats.drop("__row"), labels)
    return stats.where(~base_failed() & verdict(rules)).select("__row.*")
