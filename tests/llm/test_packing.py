import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from terrace.llm import packing
from terrace.llm.queries import WORDS, vocabulary
from tests.llm.cases import empty, frame, hard


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(WORDS))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check(tokenizer, docs, got, window=packing.WINDOW):
    """Each id in one piece, sequences gapless, none in need of padding."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0
    want = defaultdict(list)
    for doc in docs:
        ids = ids_of(tokenizer, doc[1])
        want[doc[0], len(ids)].append(ids)
    assert set(pieces) == set(want)
    for key, several in want.items():
        left = Counter(pieces[key])
        for ids in several:
            start = 0
            while start < len(ids):
                fit = [p for p in left if p[0] == start and left[p] and p[2] == crc(ids[start : start + p[1]])]
                assert fit, (key, start)
                left[fit[0]] -= 1
                start += fit[0][1]
            assert start == len(ids)
        assert not +left


def corpus(n=700):
    rng = np.random.default_rng(3)
    words = "Spark packs 12 tokens’ windows, isn't it? don’t; Ünïcode\tÉé\n".split(" ")
    return [(i, " ".join(rng.choice(words, int(rng.exponential(120)))), "en", "a", 0) for i in range(n)]


def test_ids_are_the_library_s(tokenizer):
    texts = [t or "" for _, t, *_ in hard() + corpus(50)]
    texts += ["a<|endoftext|>b  c", "  two  spaces ", "ΟΔΟΣ Σ σς", "é ́x a b c\x1cd\x85e", "I'LL we'Re '", "\n", " "]
    with open(vocabulary(WORDS), "rb") as file:
        words = packing.Words(file.read())
    for some in (texts, texts[::-1]):
        ids, offsets = packing.token_ids(words, pa.array(some, pa.string()))
        for text, a, b in zip(some, offsets, offsets[1:]):
            assert ids[a:b].tolist() == ids_of(tokenizer, text), text


def test_words_are_kept_within_bounds(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "KEPT", 50)
    with open(vocabulary(WORDS), "rb") as file:
        words = packing.Words(file.read())
    for k in range(40):
        text = " ".join(f"Word{'abc' * i}{i}," for i in range(k * 5, k * 5 + 20))
        ids, _ = packing.token_ids(words, pa.array([text]))
        assert ids.tolist() == ids_of(tokenizer, text)
        assert len(words.words) < 150


def test_all_latin_letters(tokenizer):
    with open(vocabulary(WORDS), "rb") as file:
        words = packing.Words(file.read())
    for c in map(chr, range(0x21, 0x600)):
        text = f"a{c}b {c}.  x{c}!? {c}{c} 1{c} <|{c}|>"
        assert packing.token_ids(words, pa.array([text]))[0].tolist() == ids_of(tokenizer, text), hex(ord(c))


def test_packs_all_ids(spark, tokenizer):
    docs = corpus() + [(-1, "word " * 30_000, "en", "a", 0)]
    got = packing.pack(frame(spark, docs, extra=True).repartition(3), vocabulary(WORDS)).collect()
    check(tokenizer, docs, got)
    cut = Counter((r.doc_id, r.doc_tokens) for r in got if r.doc_tokens < packing.WINDOW)
    assert sum(n > 1 for n in cut.values()) < 0.1 * len(docs)


def test_few_open_windows(spark, tokenizer):
    docs = corpus(300)
    got = packing.pack(frame(spark, docs).repartition(2), vocabulary(WORDS), window=128, most_open=3).collect()
    check(tokenizer, docs, got, 128)


def test_hard_rows(spark, tokenizer):
    docs = hard() + [(1, "same", "en", "a", 0)] * 5
    check(tokenizer, docs, packing.pack(frame(spark, docs, extra=True), vocabulary(WORDS)).collect())
    assert packing.pack(empty(spark), vocabulary(WORDS)).count() == 0


def test_each_piece_goes_where_the_squares_grow_least():
    rng, window = np.random.default_rng(11), 24
    packer, levels = packing.Packer(window, 10**9), Counter()
    for i in range(3000):
        size = int(rng.integers(1, window))

        def squares(level):
            after = levels.copy()
            after[level] -= 1
            after[level + size] += 1
            return sum(n * n for h, n in after.items() if 0 < h < window)

        options = [0] + [h for h, n in levels.items() if n and 0 < h <= window - size]
        best = min(squares(h) for h in options)
        level = max(h for h in options if squares(h) == best)
        assert packer._level(size) == level
        packer.add((i, size), np.zeros(size, dtype="<u4"))
        levels[level] -= level > 0
        levels[level + size] += level + size < window
        assert {h: n for h, n in levels.items() if n and h} == {h: n for h, n in enumerate(packer.count.tolist()) if n}


def test_open_windows_are_bounded():
    packer = packing.Packer(window=64, most_open=5)
    for i in range(1000):
        packer.add((i, 33), np.zeros(33, dtype="<u4"))
        assert packer.n_open <= 5
    held = packer.closed() + packer.rest()
    assert sum(len(ids) for w in held for _, _, ids in w) == 33_000
