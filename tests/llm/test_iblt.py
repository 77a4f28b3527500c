import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.llm import iblt
from tests.llm.cases import empty, frame, hard


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400))), max_size=6))
def test_differences_are_recovered_exactly(pairs):
    keys = lambda s: iblt.mixed(np.array(sorted(s), dtype=np.uint64), 5)
    old, new = [keys(a) for a, _ in pairs], [keys(b) for _, b in pairs]
    for (a, b), (x, y, _) in zip(pairs, iblt.differences(old, new)):
        assert set(x.tolist()) == set(keys(a - b).tolist())
        assert set(y.tolist()) == set(keys(b - a).tolist())


def test_retries_with_larger_sketches_only_where_needed():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    found = iblt.differences([base, base, base], [base, base[2:], base[:2500]])
    assert [len(x) for x, _, _ in found] == [0, 2, 2500]
    assert found[0][2] == found[1][2] == iblt.CELLS and found[2][2] >= 2500


def test_paragraphs():
    text = "One. Two!\nThree\nOne. " + "x" * 300
    assert len(iblt.digests(text)) == len(set(iblt.digests(text).tolist())) == 5
    assert len(iblt.digests("")) == len(iblt.digests(" \n ")) == 0
    assert (iblt.digests("a\nb") == iblt.digests("a\n b ")).all()


def test_long_runs_are_cut_where_their_content_says():
    r = random.Random(6)
    run = "".join(r.choices("abcdefgh 中文", k=20_000))
    for changed in ("z" + run, run[:9000] + "zz" + run[9000:], run[1:]):
        old, new = set(iblt.digests(run).tolist()), set(iblt.digests(changed).tolist())
        assert len(old) > 40 and len(old & new) >= 0.9 * len(old)
    for run in ("x" * 50_000, "ab" * 9000, run):
        assert "".join(iblt.pieces(run)) == run and max(map(len, iblt.pieces(run))) <= iblt.MOST
    assert all(iblt.LEAST <= len(p) for p in iblt.pieces(run)[:-1])


def test_rows_of_one_id_are_in_many_ranges(spark):
    for row_id in (None, 7):
        docs = [(row_id, f"text {i}. of its own", "en", "a", 0) for i in range(1000)]
        dealt, n = iblt.with_next(frame(spark, docs))
        sizes = [r["count"] for r in dealt.where("NOT tail").groupBy("range").count().collect()]
        assert len(sizes) > n // 2 and max(sizes) < 300 and sum(sizes) == 1000
    docs = [(i, "x", "en", "a", 0) for i in (-(1 << 63), -5, -1, 0, 1, 9, (1 << 63) - 1, None)]
    rows = iblt.with_next(frame(spark, docs))[0].where("NOT tail").orderBy("range", F.col("doc_id").desc_nulls_last()).collect()
    assert [r.doc_id for r in rows] == [(1 << 63) - 1, 9, 1, 0, -1, -5, -(1 << 63), None]


def want(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]

        def alike(x, y):
            a, b = set(iblt.digests(x).tolist()), set(iblt.digests(y).tolist())
            return len(a & b) / len(a | b) if a | b else 1.0

        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(text, edited), alike(text, following))
    return out


def test_edits_against_brute_force(spark):
    r = random.Random(4)
    lines = [f"line {i} of some text." for i in range(40)]
    docs = [(i * 7, "\n".join(r.choices(lines, k=r.randint(0, 12))), "en", "a", 0) for i in range(300)]
    docs += [(3, None, None, None, None), (5, "", "en", "a", 0), (8, hard()[8][1], "en", "a", 0), (10, "ab" * 60_000, "en", "a", 0)]
    got = iblt.fingerprint_edits(frame(spark, docs, extra=False)).collect()
    expected = want(docs)
    assert len(got) == len(docs)
    for row in got:
        n, sha, edited, following = expected[row.doc_id]
        assert (row.n_chars, row.edited_sha256) == (n, sha)
        assert abs(row.near_edited - edited) < 1e-12 and abs(row.near_next - following) < 1e-12
    prints = {}
    for row in got:
        prints.setdefault(next(d[1] or "" for d in docs if d[0] == row.doc_id), set()).add(row.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_hard_and_few_rows(spark):
    assert iblt.fingerprint_edits(frame(spark, hard(), extra=True).drop("a.b")).count() == len(hard())
    assert iblt.fingerprint_edits(empty(spark)).count() == 0
    one = iblt.fingerprint_edits(frame(spark, [(1, "a. b. c. d.", "en", "a", 0)])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_compare(spark):
    df = spark.createDataFrame([("a\nb\nc", "a\nc\nd", 1), (None, "x", 2), ("", None, 3)], "old string, new string, likeness int")
    got = sorted(iblt.compare(df, "old", "new").collect(), key=lambda r: str(r.old))
    assert [(len(r.only_old), len(r.only_new), r.likeness) for r in got] == [(0, 0, 1.0), (0, 1, 0.0), (1, 1, 0.5)]
