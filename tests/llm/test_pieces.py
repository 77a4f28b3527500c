import hashlib
import random
import resource

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import pieces
from terrace.llm.queries import piece_model
from tests.llm.cases import empty, frame, hard


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aabbcdethin ▁\n\t=-!0 éßЖ中😀\x00́<>/"), max_size=80))
def test_encodes_and_decodes_as_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    model = pieces.model_at(piece_model())
    want = [*library.encode(text), model.end]
    assert model.encode(text) == want
    assert model.decode(want) == library.decode(want)
    known, codes, ends = pieces.encode_chunk(model, [text, "", text])
    ids, offsets = pieces.ids_of(model, known, codes, ends)
    assert [x.tolist() for x in np.split(ids, offsets[1:-1])] == [want, [model.end], want]
    assert [t[1:] for t in pieces.texts_of(known, 2, codes, ends, "")] == [library.decode(want), "", library.decode(want)]


def test_decodes_any_ids_as_the_library(library):
    model, r = pieces.model_at(piece_model()), random.Random(1)
    for _ in range(2000):
        ids = [r.choice([r.randrange(259), r.randrange(32_000)]) for _ in range(r.randint(0, 9))]
        assert model.decode(ids) == library.decode(ids)


def test_long_words_and_runs_of_equal_merges(library):
    model, r = pieces.model_at(piece_model()), random.Random(2)
    for text in ("a" * 3001, " " * 99, "=" * 777, "".join(r.choice("abcde") for _ in range(30_000))):
        assert model.encode(text)[:-1] == library.encode(text)


def test_a_worker_remembers_a_bounded_number_of_bytes(library):
    """Units of 300 CJK characters, and many short ones: the process grows by less than 200 MB."""
    model = pieces.PieceModel(open(piece_model(), "rb").read())
    r, most = random.Random(3), 0
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for k in range(60):
        long = ["▁" + "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(300)) for _ in range(40)]
        short = ["▁" + "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(12)) for _ in range(1500)]
        known = model.pieces_of(long + short)
        most = max(most, len(model.cache))
        if k == 0:
            assert [x[0] for x in known[:5]] == [len(library.encode(u[1:])) for u in long[:5]]
    assert not any(len(u) > pieces.LONGEST for u in model.cache) and model.held <= pieces.CACHE * 1.1
    assert most <= pieces.CACHE // pieces.ENTRY
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200 << 10


def test_rows(spark, library):
    rows = hard()
    got = pieces.encode(frame(spark, rows, extra=True), piece_model()).collect()
    want = [[*library.encode(r[1] or ""), 2] for r in rows]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(((r[0], w) for r, w in zip(rows, want)), key=str)
    assert {r["a.b"] for r in got} == {"dot"}
    digests = pieces.encode_digests(frame(spark, rows), piece_model()).collect()
    assert len(digests) == len(rows)
    by_id = {r.doc_id: r for r in digests if r.doc_id is not None}
    for r, ids in zip(rows, want):
        if r[0] is not None:
            d = by_id[r[0]]
            assert d.n_tokens == len(ids)
            assert d.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert d.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encode_digests(empty(spark), piece_model()).count() == 0
