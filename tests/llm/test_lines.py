import hashlib
import random

import pytest

from terrace.llm import lines
from tests.llm.cases import empty, frame, hard
from tests.llm.cases import words as words_of


def brute(docs):
    """Remaining text of each distinct document (doc_id, text), and how many chunks were found and went."""
    key = lambda i, t: hashlib.md5(f"{'-' if i is None else i}:{t}".encode()).hexdigest()
    order = sorted({(i, t or "") for i, t, *_ in docs}, key=lambda d: (d[0] is None, d[0] or 0, key(*d)))
    seen, out = set(), {}
    for i, text in order:
        parts = text.split("\n")
        marked = [False] * len(parts)
        for a in range(len(parts)):
            long = parts[a].count(" ") >= lines.LEAST - 1
            for b in (a + 1, a + 2):
                if b <= len(parts) and (b > a + 1 or long):
                    unit = b - a, *parts[a:b]
                    if unit in seen:
                        marked[a:b] = [True] * (b - a)
                    seen.add(unit)
        left, found, gone, a = [], 0, 0, 0
        while a < len(parts):
            b = a
            while b < len(parts) and marked[b] == marked[a]:
                b += 1
            chunk = parts[a:b]
            removed = marked[a] and len(words_of("\n".join(chunk))) >= lines.LEAST
            found, gone = found + marked[a], gone + removed
            left += [] if removed else chunk
            a = b
        out[i, text] = "\n".join(left), found, gone
    return out


def check(spark, docs, **more):
    got = lines.dedup(frame(spark, docs, **more).withColumnRenamed("lang", "was").selectExpr("*", "text AS before")).collect()
    want = brute(docs)
    assert len(got) == len(docs)
    for r in got:
        assert (r.text or "", r.n_chunks, r.n_removed) == want[r.doc_id, r.before or ""]
        assert (r.text is None) == (r.before is None)


PASSAGE = [f"passage line {i} with a few words" for i in range(40)]


def test_shared_passages_go_wherever_they_stand(spark):
    docs = [(i, "\n".join([f"own {i} {k}" for k in range(i)] + PASSAGE + [f"tail {i}"]), "", "", 0) for i in range(1, 40)]
    check(spark, docs)
    got = lines.dedup(frame(spark, docs)).where("doc_id > 1").collect()
    for r in got:
        assert f"tail {r.doc_id}" in r.text and f"own {r.doc_id} 0" in r.text
        assert not any(x in r.text for x in PASSAGE)


def test_two_lines_are_a_passage(spark):
    passage = "\n".join(" ".join(f"w{k}{i}" for i in range(28)) for k in range(2))
    docs = [(i, f"head {i}\n{passage}\ntail {i}", "", "", 0) for i in range(9)]
    check(spark, docs)
    got = lines.dedup(frame(spark, docs)).orderBy("doc_id").collect()
    assert [passage in r.text for r in got] == [True] + [False] * 8
    assert all(r.text == f"head {r.doc_id}\ntail {r.doc_id}" for r in got[1:])


def test_long_line_counts_as_a_chunk(spark):
    passage = " ".join(f"w{i}" for i in range(55))
    docs = [(i, f"head {i}\n{passage}\ntail {i}", "", "", 0) for i in range(9)]
    check(spark, docs)
    got = lines.dedup(frame(spark, docs)).orderBy("doc_id").collect()
    assert [passage in r.text for r in got] == [True] + [False] * 8
    assert all(r.text == f"head {r.doc_id}\ntail {r.doc_id}" for r in got[1:])


def test_short_lines_and_own_text_stay(spark):
    docs = [(i, f"the same short line\nand another\nown {i}" if i % 2 else f"quite other {i}", "", "", 0) for i in range(20)]
    check(spark, docs)
    assert lines.dedup(frame(spark, docs)).where("n_removed > 0").count() == 0


def test_passages_put_together_from_several(spark):
    first, second = PASSAGE[:9], PASSAGE[20:29]
    docs = [(1, "\n".join(first), "", "", 0), (2, "\n".join(second), "", "", 0), (3, "\n".join(first + second + first), "", "", 0)]
    docs += [(4, "\n".join([*first[:2], "between", *first[2:]] * 2), "", "", 0)]
    check(spark, docs)


def test_the_earliest_copy_of_each_line_stays(spark):
    docs = [(i, "\n".join(PASSAGE[i % 7 : i % 7 + 12 + i % 5] + PASSAGE[i % 11 : i % 11 + 9]), "", "", 0) for i in range(40)]
    check(spark, docs)
    left = {x for r in lines.dedup(frame(spark, docs)).collect() for x in r.text.split("\n")}
    assert left >= {x for d in docs for x in d[1].split("\n")}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_documents(spark, seed):
    r = random.Random(seed)
    some = ["a", "b" + " b" * 30, "c" + " c" * 60, "", ":", "d" + " d" * 60]
    docs = [(r.choice([None, *range(9)]), "\n".join(r.choices(some, k=r.randrange(9))), "", "", 0) for _ in range(120)]
    check(spark, docs)


def test_hard_rows(spark):
    check(spark, hard() + hard()[5:6], extra=True)
    df = frame(spark, hard(), extra=True)
    assert lines.dedup(df).columns == [c for c in df.columns if c not in ("n_chunks", "n_removed")] + ["n_chunks", "n_removed"]
    assert lines.digests(empty(spark)).count() == 0
