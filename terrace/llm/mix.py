"""Mixing sources to target weights: entropy balancing by distributed Newton iterations."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.ranks import written_out
from terrace.llm.text import by_all, discard, stored, whole, words

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order of their names, repeating
SHARE = 1.5  # words of the mix against those of all documents
CAP = 2.0  # copies of one document, and words of a source, at most
STEPS = 200  # a bracket of 2e4 is halved to the last bit of a double in less than half of that
CLOSE = 1e-9  # relative distance from the target at which a source is done
DIGITS = 9  # rates are rounded to so many, so that reruns agree whatever the order of sums
RUN = 1024  # documents that are rounded in one run, about


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source with its size and target words.

    Sources share ``SHARE`` of all words by their weights, each at most ``CAP``
    times its own; what is cut off goes to the others by weight, until none is
    above. That ends where each source has the lesser of its limit and a
    common level times its weight. With the sources in order of limit over
    weight, the level is the first one at which the next source is not cut. The
    frame has one row per source, and so have the windows over it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sources.withColumn("weight", F.get(F.array(*map(F.lit, WEIGHTS)), rank))
    limit = CAP * F.col("source_size")
    by_ratio = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = SHARE * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    found = weighed.withColumn("level", level)
    fits = F.col("level") <= limit / F.col("weight")
    common = F.coalesce(F.min(F.when(fits, F.struct(limit / F.col("weight"), F.col("level")))).over(everything)["level"], F.lit(float("inf")))
    return found.withColumn("common", common).select(
        "source", "source_size", F.least(limit, F.col("common") * F.col("weight")).cast("double").alias("target")
    )


def rate(tilt: Column, size: Column, mean: Column) -> Column:
    """Expected copies of a document: 1 tilted exponentially by its size, between 0 and ``CAP``."""
    return CAP / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * size / mean))))


def tilts(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """The dual variable of each source, by Newton steps kept within a bracket.

    Among all rates between 0 and ``CAP`` that give a source its target words,
    those closest to one copy each in relative entropy have the form of
    ``rate`` with one dual variable per source, at which the convex dual has
    its minimum. Documents of one source and size have the same rate, so each
    step is a sum over the distinct sizes. All sources are advanced in one job.
    A target of ``CAP`` times the size has its solution at infinity.
    """
    known = goals.where("source_size > 0").select("source", "source_size", "target")
    counted = sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    same = F.col("c.source").eqNullSafe(F.col("g.source"))
    cells = counted.alias("c").join(known.alias("g"), same).select("c.source", "size", "n", "source_size", "target")
    docs_of = Window.partitionBy("source")
    cells = stored(cells.withColumn("mean", F.col("source_size") / F.sum("n").over(docs_of)), "cells")
    state = cells.groupBy("source").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    open_ = F.col("target") < CAP * F.col("source_size") * (1 - 1e-12)
    state = state.select(
        "source",
        F.when(open_, F.lit(0.0)).otherwise(F.lit(float("inf"))).alias("tilt"),
        F.lit(-1e4).alias("low"),
        F.lit(1e4).alias("high"),
        (~open_).alias("done"),
    )
    state = stored(state, "tilts")
    for step in range(STEPS):
        same = F.col("c.source").eqNullSafe(F.col("s.source"))
        both = cells.alias("c").join(state.alias("s"), same).where("NOT done")
        x, m = F.col("size").cast("double"), F.col("mean")
        w = rate(F.col("tilt"), x, m)
        sums = both.groupBy("s.source").agg(
            F.first("tilt").alias("tilt"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
            F.first("target").alias("target"),
            F.sum(F.col("n") * x * w).alias("got"),
            F.sum(F.col("n") * x * x / m * w * (1 - w / CAP)).alias("slope"),
        )
        excess = F.col("got") - F.col("target")
        low = F.when(excess < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(excess > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(excess, F.col("slope"))
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        if step >= 20 and step % 3 == 0:  # should Newton steps creep, the bracket is halved in between
            inside = F.lit(False)
        close = F.abs(excess) <= CLOSE * F.col("target")
        close = close | (high - low <= 1e-12 * F.greatest(F.lit(1.0), F.abs(F.col("tilt"))))  # as near as doubles get
        moved = sums.select(
            "source",
            F.when(close, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"),
            low.alias("low"),
            high.alias("high"),
            close.alias("done"),
        )
        before, state = state, stored(moved.unionByName(state.where("done")), "tilts")
        discard(before)
        if state.where("NOT done").isEmpty():
            break
    else:
        raise ArithmeticError(f"the dual of {state.where('NOT done').first()['source']!r} was not solved in {STEPS} steps")
    return state.select("source", F.round("tilt", 9).alias("tilt"))


def sized_runs(docs: DataFrame, column: str = "text") -> DataFrame:
    """Every row with its size, its source's size and target, its rate, and the run in which it is rounded."""
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words(whole(column))).cast("long").alias("size"),
        F.md5(whole(column).cast("binary")).alias("mark"),
    )
    alike = sized.groupBy(*sized.columns).agg(F.count("*").alias("_n"))
    sized = stored(written_out(stored(alike, "alike")), "sizes")
    goals = stored(targets(sized.select("source", "size")), "targets")
    found = tilts(sized.select("source", "size"), goals)
    counts = sized.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("size") > 0).alias("m"))
    facts = goals.alias("g").join(counts.alias("k"), F.col("g.source").eqNullSafe(F.col("k.source")))
    facts = facts.join(found.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left")
    facts = facts.select("g.source", "source_size", "target", "n", "m", "tilt")
    rows = sized.alias("d").join(facts.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source")))
    x = F.col("size").cast("double")
    expected = rate(F.coalesce(F.col("tilt"), F.lit(0.0)), x, F.col("source_size") / F.greatest("m", F.lit(1)))
    expected = F.when(F.col("size") > 0, F.round(F.least(F.lit(CAP), expected), DIGITS)).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id",
        F.col("d.source").alias("source"),
        "size",
        "source_size",
        "target",
        "mark",
        expected.alias("rate"),
        F.pmod(F.xxhash64("mark", "doc_id", "_copy"), F.ceil(F.col("n") / RUN)).alias("run"),
    )


def copies(docs: DataFrame, column: str = "text") -> DataFrame:
    """Every row of ``docs`` (doc_id, source) with sizes, its source's target, and its copies.

    A text without words has size 0 and no copies; a null source is a source of
    its own. Documents are rounded in runs, from the longest to the shortest:
    each gets the copies that bring the words taken so far closest to those
    expected, so a run ends within about half of its shortest document of its
    share. Runs are dealt by a hash, so a large source is rounded in many of
    them; rows alike in all of this are numbered, and dealt like others. They stand
    in no order, but then it does not matter which is which. Reruns agree. An
    empty table gives an empty one; other columns are not looked at.
    """
    schema = "doc_id long, source string, mark string, size long, source_size long, target double, copies long"
    return sized_runs(docs, column).groupBy("source", "run").applyInPandas(rounded, schema)


def rounded(run: pd.DataFrame) -> pd.DataFrame:
    """The rows of one run with their copies."""
    run = run.sort_values(["size", "mark", "doc_id"], ascending=[False, True, True], na_position="last")
    out, behind = [], 0.0
    for size, expected in zip(run["size"].tolist(), run["rate"].tolist()):
        behind += size * expected
        taken = min(int(CAP), max(0, round(behind / size))) if size else 0
        behind -= taken * size
        out.append(taken)
    run["copies"] = out
    return run[["doc_id", "source", "mark", "size", "source_size", "target", "copies"]]


def mixed(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it, with its own columns.

    Rows alike in doc_id, source and text are one document here, with the
    copies that all of them get, each like the first of them by all columns.
    """
    # the digest of the text is that of ``copies``; a null must not be equal to a value
    key = F.concat_ws(
        ":",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
        F.md5(whole().cast("binary")),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")),
    )
    taken = copies(docs.select("doc_id", "source", "text"))
    source = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-"))
    mark = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "mark", source)
    totals = taken.groupBy(mark.alias("__key")).agg(F.sum("copies").alias("__n")).where("__n > 0")
    rows = docs.withColumn("__key", key).join(totals, "__key")
    nth = F.row_number().over(Window.partitionBy("__key").orderBy(*by_all(docs)))
    rows = rows.withColumn("__nth", nth).where("__nth = 1")
    every = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    return every.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return copies(docs).select("doc_id", "size", "source_size", "target", taken)
