"""Small tables with the cases every operator must bear."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = " ".join(f"w{i % 977}" for i in range(20_000))


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def hard() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    same = "one two three four five six seven eight nine ten"
    return [
        (1, same, "en", "a", 1),
        (1, same, "en", "a", 1),
        (2, same, None, "b", None),
        (3, None, "en", "a", 0),
        (4, "", "en", None, 0),
        (None, same + " eleven", "en", "a", 3),
        (None, None, None, None, None),
        (5, " \t\n\r\x0b\x0c ", "en", "b", 7),
        (6, LONG, "en", "a", len(LONG)),
        (7, "x" * 50_000, "en", "c", 50_000),
        (8, "Ünïcode ΣΑΣ İ 😀 中文 \x00 end", "en", "😀", 20),
        (9, "line one\nline two\nline one\n\nline two", "en", "b", 5),
    ]


def frame(spark, rows: list[tuple], extra: bool = False):
    """A frame of documents; ``extra`` adds columns named like those that operators use."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        names = "key spans mark class n copies tokens size ids decoded n_chunks n_removed root raw rate run part".split()
        df = df.selectExpr("*", *[f"'x' AS `{n}`" for n in names], "'dot' AS `a.b`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
