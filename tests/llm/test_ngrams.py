import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import ngrams, trie
from tests.llm.cases import LOWER, empty, frame, hard, words


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=3000), st.data())
def test_sequences(values, data):
    values = np.sort(np.array(values, dtype=np.uint64))
    sequence = trie.Sequence(trie.monotone(values))
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert (sequence.slice(a, b) == values[a:b]).all()


def test_trie_finds_what_it_holds(monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 256)
    rng = np.random.default_rng(1)
    pairs = sorted({(int(w) % 700, int(c)) for w, c in zip(rng.zipf(1.3, 20_000), rng.integers(0, 1 << 12, 20_000) << 20)})
    words_, contexts = (np.array(x) for x in zip(*pairs))
    own, first = np.unique(words_, return_index=True)
    value = rng.random(len(pairs))
    held = trie.Trie(own.astype(np.uint64), own / 10.0, first, contexts.astype(np.uint32), value)
    asked = sorted({*pairs[::3], *((int(a), int(b) << 20) for a, b in zip(rng.integers(0, 800, 4000), rng.integers(0, 1 << 12, 4000)))})
    a, b = np.array([q[0] for q in asked], dtype=np.uint64), np.array([q[1] for q in asked], dtype=np.uint32)
    word, pair, back, found = held.look_up(a, b)
    known = dict(zip(pairs, value))
    for i, q in enumerate(asked):
        assert word[i] == (q[0] in set(own)) and pair[i] == (q in known)
        assert not pair[i] or abs(found[i] - known[q]) < 1e-3
        assert not word[i] or abs(back[i] - q[0] / 10) < 1e-9


def brute(docs):
    tokens = [words((text or "").translate(LOWER)) + [" "] for _, text, *_ in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in docs]
    one, two = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            one.update(t)
            two.update(zip(["^", *t], t))
    total, distinct = sum(one.values()), len(one)
    p = lambda w: (one[w] + 1) / (total + distinct + 1)
    after = lambda h: one[" " if h == "^" else h]
    out = []
    for (i, *_), t, h in zip(docs, tokens, held):
        base = sum(math.log10(p(w)) for w in t)
        mu = ngrams.PRIOR
        score = sum(math.log10((two[c, w] + mu * p(w)) / (after(c) + mu)) for c, w in zip(["^", *t], t))
        out.append((i, h, len(t), sum(w in one for w in t), total, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_shard", [3_000_000, 50])
def test_scores_against_brute_force(spark, monkeypatch, per_shard):
    monkeypatch.setattr(ngrams, "PER_SHARD", per_shard)
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(f"{'W' if i % 2 else 'w'}{x}" for x in rng.zipf(1.5, rng.integers(0, 60)) % 300), "", "", 0) for i in range(150)]
    docs += hard()[:6] + hard()[10:]
    got = sorted(map(tuple, ngrams.score_documents(frame(spark, docs, extra=True)).collect()), key=str)
    want = brute(docs)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2]))):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 * abs(w[5]) and abs(g[6] - w[6]) < 2e-3 * abs(w[6])


def test_a_hot_pair_is_not_one_group(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "PER_SHARD", 500)
    monkeypatch.setattr(ngrams, "FREQUENT", 32)
    score_shard = ngrams.score_shard

    def bounded(parts, *more):
        assert sum(len(ngrams.dealt(p)[0]) for p in parts) < 4 * 500
        return score_shard(parts, *more)

    monkeypatch.setattr(ngrams, "score_shard", bounded)
    rng = np.random.default_rng(4)
    own = lambda: " ".join(f"w{x}" for x in rng.integers(0, 900, 60))
    docs = [(i, f"{own()} {'the ' * 100}{own()}", "", "", 0) for i in range(80)] + [(500, "the", "", "", 0), (501, None, "", "", 0)]
    got = sorted(map(tuple, ngrams.score_documents(frame(spark, docs)).collect()), key=str)
    for g, w in zip(got, brute(docs), strict=True):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 * abs(w[5]) and abs(g[6] - w[6]) < 2e-3 * abs(w[6])


def test_probabilities_sum_to_one(spark):
    docs = [(i, "a b a c", "", "", 0) for i in (1, 3)] + [(4, "b b", "", "", 0)]
    asked = ["a", "b", "c", "zz"]
    rows = docs + [(1000 + k, w, "", "", 0) for k, w in enumerate(asked)]
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in ngrams.score(frame(spark, rows), F.col("doc_id") >= 1000).collect()}
    end_after = {}
    counts = Counter(w for _, t, *_ in docs for w in [*t.split(), " "])
    total, distinct, mu = sum(counts.values()), len(counts), ngrams.PRIOR
    pairs = Counter(p for _, t, *_ in docs for p in zip(["^", *t.split()], [*t.split(), " "]))
    for w in asked:
        p_end = (counts[" "] + 1) / (total + distinct + 1)
        end_after[w] = (pairs[w, " "] + mu * p_end) / (counts[w] + mu)
    first = [10 ** got[1000 + k].score / end_after[w] for k, w in enumerate(asked)]
    none = (mu * (counts[" "] + 1) / (total + distinct + 1)) / (3 + mu)
    assert abs(sum(first) + none - 1) < 1e-3


def test_no_training_rows_and_empty_table(spark):
    from pyspark.sql import functions as F

    got = ngrams.score(frame(spark, hard()), F.lit(True)).collect()
    assert len(got) == len(hard()) and all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert ngrams.score_documents(empty(spark)).count() == 0
