import re

from terrace.llm import rules
from terrace.llm.stats import SYMBOLS, statistics
from tests.llm.cases import empty, frame, hard, words


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for i, x in enumerate(windows):
        seen.setdefault(x, []).append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in SYMBOLS)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)


def labelled(spark, n=600):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(f"w{(i * 31 + k * k) % 5000}x{k}" + ("###" if bad and k % 2 else "") for k in range(60 + i % 7))
        docs.append((i, text, "en", "a", len(text)))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 0, 0), (3, None, 0), (99_999, 0, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_statistics(spark):
    rows = [*hard(), (20, "a b c a b c a b c", "", "", 0), (21, "a a a a a", "", "", 0), (22, "# * $ % & | < > ok\n\n \n ok\nok", "", "", 0)]
    rows.append((23, "p q r " * 40 + "z", "", "", 0))
    rows = [r for r in rows if r[0] is not None]
    for r in statistics(frame(spark, rows), "doc_id").collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), text[:50]


def test_learns_the_rule_that_labels_follow(spark):
    docs, labels = labelled(spark)
    got = rules.judge(frame(spark, docs), labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.base_failed is False
        assert r.kept is (r.doc_id % 4 != 0)
    assert rules.learn(statistics(frame(spark, docs), "doc_id"), labels)


def test_nothing_to_learn_from_keeps_all_but_the_base_rules(spark):
    docs, labels = labelled(spark, 40)
    for marks in (labels.limit(0), labels.where("quality = 1")):
        got = rules.judge(frame(spark, docs + hard(), extra=True), marks).collect()
        assert len(got) == len(docs) + len(hard())
        assert all(r.kept is not r.base_failed for r in got)
    assert rules.judge(empty(spark), labels.limit(0)).count() == 0


def test_base_rules(spark):
    rows = [(1, "w " * 60, "", "", 0), (2, " ".join(f"v{i}" for i in range(50)), "", "", 0), (3, " ".join(f"v{i}" for i in range(49)), "", "", 0)]
    _, labels = labelled(spark, 1)
    got = {r.doc_id: r for r in rules.judge(frame(spark, rows), labels.limit(0)).collect()}
    assert (got[1].base_failed, got[2].base_failed, got[3].base_failed) == (True, False, True)


def test_stage_keeps_rows_and_columns(spark):
    docs, labels = labelled(spark)
    df = frame(spark, docs + hard(), extra=True)
    left = rules.keep_good(df, labels)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} >= {r[0] for r in docs if r[0] % 4}
    assert not re.search("###", " ".join(r.text for r in left.collect()))
