import zlib

import numpy as np

from terrace.llm import fm
from tests.llm.cases import empty, frame, hard
from tests.llm.test_rules import labelled


def test_pairs_by_sums_of_squares():
    rng = np.random.default_rng(1)
    n, size = 5, fm.BUCKETS + len(fm.DENSE)
    model = fm.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, fm.FACTORS)), np.zeros(0), np.zeros(0))
    index = np.concatenate([rng.choice(size, 7, replace=False) for _ in range(n)])
    value = rng.normal(size=7 * n)
    margin = model.margin(fm.Rows(index, value, np.arange(0, 7 * n + 1, 7)))[0]
    for row in range(n):
        at = slice(row * 7, row * 7 + 7)
        i, x = index[at], value[at]
        want = 0.3 + model.weight[i] @ x
        want += sum(model.factor[i[a]] @ model.factor[i[b]] * x[a] * x[b] for a in range(7) for b in range(a + 1, 7))
        assert abs(margin[row] - want) < 1e-9


def test_held_out_rows_are_told_apart(spark):
    docs, labels = labelled(spark)
    got = fm.classify(frame(spark, docs, extra=True), labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out is (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 != 0) for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = labelled(spark, 200)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    scores = lambda marks: {r.doc_id: r.score for r in fm.classify(frame(spark, docs), marks).collect()}
    assert scores(labels) == scores(turned)


def test_hard_rows(spark):
    docs, labels = labelled(spark, 60)
    got = fm.classify(frame(spark, docs + hard()), labels).collect()
    assert len(got) == 60 + len(hard()) and all(np.isfinite(r.score) for r in got)
    same = {r.score for r in got if r.doc_id in (3, 4, 5) and r.doc_id not in {d[0] for d in docs}}
    assert len(same) <= 1
    for marks in (labels.limit(0), labels.where("quality = 0")):
        assert all(0 <= r.score <= 1 for r in fm.classify(frame(spark, hard()), marks).collect())
    assert fm.classify(empty(spark), labels).count() == 0
