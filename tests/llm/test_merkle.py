import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrace.llm import merkle, ranks
from tests.llm.cases import empty, frame, hard


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row
    shown = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in shown))


def tree(leaves: list[str], fan: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf its siblings (before, after) at each level."""
    nodes, below, steps = leaves, [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        parents, under = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for k in range(len(run)):
                for i in below[a + k]:
                    steps[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            parents.append(sha("".join(run)))
            under.append([i for part in below[a : a + fan] for i in part])
        nodes, below = parents, under
    return nodes[0], steps


def brute(docs: list[tuple], fan: int = 3) -> list[tuple]:
    by_source = defaultdict(list)
    for row in docs:
        by_source[row[3]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    placed = {}
    for source in order:
        rows = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        placed[source] = rows, *tree([leaf(r) for r in rows], fan)
    root, upper = tree([placed[s][1] for s in order], fan)
    out = []
    for source, above in zip(order, upper):
        rows, subroot, steps = placed[source]
        for row, own in zip(rows, steps):
            path, text = own + above, row[1]
            if text is not None and zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf((row[0], text, *row[2:]))
            for before, after in path:
                h = sha(before + h + after)
            proof = sha("".join(before + after for before, after in path))
            out.append((row[0], leaf(row), subroot, root, proof, h, h == root))
    return out


def check(spark, docs, extra=False):
    got = Counter(map(tuple, merkle.verify(frame(spark, docs, extra)).collect()))
    assert got == Counter(brute(docs))


def corpus(n: int) -> list[tuple]:
    return [
        (i * 7 % 1000, f"line {i}\nnext" if i % 3 else f"line {i}", "en", "hot" if i % 3 else ["a", "é", None, "Z"][i % 4], i)
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 200])
def test_agrees_with_brute_force(spark, n):
    check(spark, corpus(n))


def test_hard_rows(spark):
    check(spark, hard(), extra=True)
    assert merkle.verify(empty(spark)).count() == 0


def test_repeated_rows_and_one_id(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BLOCK", 7)
    check(spark, [(None, "a\nb", "en", "s", 1)] * 50 + [(2, f"t{i}", "en", "s", 1) for i in range(60)])


def test_tampering_shows_only_where_line_ends_went(spark):
    docs = corpus(120)
    changed = {r[0] for r in docs if "\n" in r[1] and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert {r.doc_id for r in merkle.verify(frame(spark, docs)).where("NOT verified").collect()} == changed


def test_binary_tree_pairs_by_xor(spark):
    docs = corpus(37)
    got = merkle.manifest(frame(spark, docs), fan=2)
    back = got.select("leaf", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("back"))
    want = {r[1]: r[3] for r in brute(docs, 2)}
    assert {r.leaf: r.root for r in back.collect()} == want
    assert back.where("back <> root").count() == 0


def test_ranks_of_a_hot_group_are_spread(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'cold', 'hot') AS g", "id % 5 AS k", "id AS v")
    got = ranks.positions(rows, "g", ["k"])
    most = got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 20_000
    seen = defaultdict(list)
    for r in got.collect():
        assert r["size"] == (6667 if r.g == "cold" else 13333)
        seen[r.g].append((r["at"], r.k, r.v))
    for group in seen.values():
        group.sort()
        assert [x[0] for x in group] == list(range(len(group)))
        assert [x[1:] for x in group] == sorted(x[1:] for x in group)
