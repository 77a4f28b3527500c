from collections import Counter, defaultdict

import numpy as np
import pytest

from terrace.llm import mix
from tests.llm.cases import empty, frame, hard, words


def goals(docs):
    """Targets by resharing the excess step by step."""
    size = defaultdict(int)
    for _, text, _, source, _ in docs:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: mix.WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(size.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2.0 * size[s]
                open_.remove(s)
    return size, target


def corpus(n=900):
    rng = np.random.default_rng(5)
    docs = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else [None, "a", "b", "ä", "😀", "Z"][i % 6]
        docs.append((i, " ".join("w" * (k % 5 + 1) for k in range(int(rng.exponential(60)))), "en", source, 0))
    return docs


def test_targets_and_copies(spark):
    docs = corpus()
    size, target = goals(docs)
    got = mix.copies(frame(spark, docs, extra=True)).collect()
    assert len(got) == len(docs)
    by_id = {d[0]: d for d in docs}
    taken, longest = Counter(), Counter()
    for r in got:
        assert r.size == len(words(by_id[r.doc_id][1])) and r.source == by_id[r.doc_id][3]
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= r.copies <= 2 and (r.size or not r.copies)
        taken[r.source] += r.copies * r.size
        longest[r.source] = max(longest[r.source], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s])


def test_rates_solve_the_dual(spark):
    docs = corpus(300)
    df = frame(spark, docs).selectExpr("source", "size(filter(split(text, ' '), x -> x <> '')) AS size").selectExpr("source", "cast(size AS long) AS size")
    found = {r.source: r.tilt for r in mix.tilts(df, mix.targets(df)).collect()}
    size, target = goals(docs)
    for s in target:
        x = np.array([len(words(d[1])) for d in docs if d[3] == s], dtype=float)
        x = x[x > 0]
        if np.isinf(found[s]):
            assert target[s] == pytest.approx(2 * size[s])
        else:
            rates = 2 / (1 + np.exp(-found[s] * x / x.mean()))
            assert (rates * x).sum() == pytest.approx(target[s], rel=1e-6)


def test_runs_round_alike_and_reruns_agree(spark, monkeypatch):
    docs = corpus(400)
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "copies").collect()))
    first = rows(mix.copies(frame(spark, docs)))
    assert rows(mix.copies(frame(spark, docs).repartition(5))) == first
    monkeypatch.setattr(mix, "RUN", 20)
    _, target = goals(docs)
    taken = Counter()
    for r in mix.copies(frame(spark, docs)).collect():
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 20 for s in target)


def test_mixed_repeats_rows(spark):
    docs = corpus(200) + hard()[:7]
    df = frame(spark, docs, extra=True)
    out = mix.mixed(df)
    assert out.columns == df.columns
    copies = Counter()
    for r in mix.copies(df).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_equal_rows_are_rounded_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(mix, "RUN", 100)
    for doc_id in (7, None):
        docs = [(doc_id, "five words in each row", "en", "a", 0)] * 2000 + [(i, "other words", "en", "b", 0) for i in range(500)]
        sizes = mix.copies(frame(spark, docs)).groupBy("source").agg({"copies": "sum", "source": "count"}).collect()
        assert {r.source: r["count(source)"] for r in sizes} == {"a": 2000, "b": 500}
        biggest = mix.sized_runs(frame(spark, docs)).groupBy("source", "run").count().agg({"count": "max"}).first()[0]
        assert biggest < 200


def test_a_dual_that_is_not_solved_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mix, "STEPS", 1)
    df = frame(spark, corpus(200)).selectExpr("source", "cast(size(split(text, ' ')) AS long) AS size")
    with pytest.raises(ArithmeticError):
        mix.tilts(df, mix.targets(df))


def test_which_of_equal_rows_stays_is_fixed(spark):
    docs = [(1, "the same text of a few words", lang, "a", 0) for lang in ("fr", "de", None, "en")]
    docs += [(2, f"another text {i}", "en", "b", 0) for i in range(40)]
    runs = [sorted(map(str, mix.mixed(frame(spark, docs).repartition(n)).collect())) for n in (1, 4, 7)]
    assert runs[0] == runs[1] == runs[2]


def test_hard_rows(spark):
    got = mix.digest(frame(spark, hard(), extra=True)).collect()
    assert len(got) == len(hard()) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert mix.digest(empty(spark)).count() == 0
    only_empty = mix.digest(frame(spark, [(1, "", "", "a", 0), (2, None, "", None, 0)])).collect()
    assert [(r.taken, r.target) for r in only_empty] == [(0, 0.0)] * 2
