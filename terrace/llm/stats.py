"""Statistics of a text's shape, all from built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import BLANKS, UPPER, let, whole, words

SYMBOLS = "#*$%&|<>"
SHARES = (
    "n_words",
    "mean_word",
    "symbol_share",
    "upper_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "mean_line",
)


def repeated_words(hashes: Column) -> Column:
    """Number of words, given by hashes, that lie in a 3-word window found twice or more in the text.

    Windows are compared by a 64-bit hash. Only a text with a repeated one is
    sorted, so that equal windows stand side by side.
    """

    def of(h: Column) -> Column:
        n = F.size(h) - 2
        windows = F.transform(
            F.arrays_zip(F.slice(h, 1, n).alias("a"), F.slice(h, 2, n).alias("b"), F.slice(h, 3, n).alias("c")),
            lambda x: F.xxhash64(x["a"], x["b"], x["c"]),
        )
        return F.when(n > 1, let(windows, covered)).otherwise(F.lit(0))

    def covered(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def places(order: Column) -> Column:
            again = F.filter(
                order,
                lambda x, i: F.coalesce(x["h"] == F.get(order, i + 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(order, i - 1)["h"], F.lit(False)),
            )
            three = F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
            return F.size(F.array_distinct(F.flatten(three)))

        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows), let(F.array_sort(placed), places)
        ).otherwise(F.lit(0))

    return let(hashes, of)


def counts(text: Column, tokens: Callable[[Column], Column] = words, more: dict[str, Callable] | None = None) -> Column:
    """A struct of counts of a text that is not null.

    ``tokens`` gives the words that are counted; ``more`` names further fields that
    are made of their hashes, so that who needs those splits the text no second time.
    """

    def lines(all_lines: Column) -> Column:
        return F.struct(F.size(all_lines).alias("n"), F.size(F.array_distinct(all_lines)).alias("own"))

    def of(hashes: Column) -> Column:
        return F.struct(
            F.size(hashes).cast("long").alias("n_words"),
            repeated_words(hashes).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(hashes)).alias("distinct"),
            *[make(hashes).alias(name) for name, make in (more or {}).items()],
        )

    return F.struct(
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, UPPER, ""))).alias("n_upper"),
        let(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lines).alias("lines"),
        let(F.transform(tokens(text), lambda w: F.xxhash64(w)), of).alias("words"),
    )


def statistics(
    docs: DataFrame,
    *keep: str,
    column: str = "text",
    tokens: Callable[[Column], Column] = words,
    more: dict[str, Callable] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` beside counts and shares of each whole text, and ``more`` (see ``counts``).

    Null counts as empty; every statistic of an empty text is 0.
    """
    rows = docs.select(*keep, counts(whole(column), tokens, more).alias("__c"))
    c = F.col("__c")
    per = lambda x, n: F.when(n > 0, x / n).otherwise(F.lit(0.0)).cast("double")
    n_words, lines = c["words"]["n_words"], c["lines"]
    return rows.select(
        *keep,
        n_words.alias("n_words"),
        c["word_chars"].alias("word_chars"),
        c["n_symbols"].alias("n_symbols"),
        (lines["n"] - lines["own"]).cast("long").alias("n_dup_lines"),
        c["words"]["n_repeat_words"].alias("n_repeat_words"),
        per(c["word_chars"], n_words).alias("mean_word"),
        per(c["n_symbols"], c["word_chars"]).alias("symbol_share"),
        per(c["n_upper"], c["word_chars"]).alias("upper_share"),
        per(lines["n"] - lines["own"], lines["n"]).alias("dup_line_share"),
        per(c["words"]["n_repeat_words"], n_words).alias("repeat_share"),
        per(c["words"]["distinct"], n_words).alias("distinct_share"),
        per(n_words, lines["n"]).alias("mean_line"),
        *[c["words"][name].alias(name) for name in more or {}],
    )
