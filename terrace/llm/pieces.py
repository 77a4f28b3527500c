"""SentencePiece BPE as vectorised merge rounds over flat symbol arrays."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import over_chunks, shipped, whole

SPACE = "▁"
NO_RANK = np.int64(1) << 40
SPREAD = np.uint64(0x9E3779B97F4A7C15)
CACHE = 64 << 20  # bytes of words and their pieces that a worker remembers, about; only speed depends on it
ENTRY = 500  # bytes that a remembered word takes besides its characters and pieces
LONGEST = 100  # characters of a word that is remembered


class PieceModel:
    """Vocabulary of a BPE model file, with the tables that the merge rounds need.

    The file is read with the sentencepiece library; encoding and decoding are
    done here. Texts are taken as they are (identity normalisation) with one
    space put in front, as the model file demands; others are refused.
    """

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=data)
        if model.normalize("ﬁ  a ") != f"{SPACE}ﬁ{SPACE * 2}a{SPACE}":
            raise ValueError("the model normalises its text; only identity with a leading space is supported")
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.name = list(map(str, range(n)))
        self.end = model.eos_id()
        self.unknown = model.unk_id()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        if any(model.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.byte_id = {int(self.piece[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = np.full(n, -1)
        for value, i in self.byte_id.items():
            self.byte_of[i] = value
        self.control = [model.is_control(i) for i in range(n)]
        self.shown = ["" if self.control[i] else p.replace(SPACE, " ") for i, p in enumerate(self.piece)]
        self.shown[self.unknown] = " ⁇ "
        self.id_of = {p: i for i, p in enumerate(self.piece) if not special[i]}
        # the rank of a merge is that of its product: equal scores share one
        scores = np.array([model.get_score(i) for i in range(n)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.chars = {p: i for p, i in self.id_of.items() if len(p) == 1}
        triples, follows = [], set()
        # symbols are ids, or n + code point for a character without a piece
        for p, i in self.id_of.items():
            follows.update(zip(p, p[1:]))
            for cut in range(1, len(p)):
                left, right = self._symbol(p[:cut]), self._symbol(p[cut:])
                if left is not None and right is not None:
                    triples.append((left << 22 | right, i, rank[i]))
        triples.sort()
        table = np.array(triples, dtype=np.int64).reshape(-1, 3)
        self._index(table[:, 0])
        self.product, self.rank = np.r_[table[:, 1], -1], np.r_[table[:, 2], NO_RANK]
        self.follows = np.unique(np.array([ord(a) << 21 | ord(b) for a, b in follows], dtype=np.int64))
        self.n = n
        self.char_id = np.full(0x110000, -1, dtype=np.int64)
        for c, i in self.chars.items():
            self.char_id[ord(c)] = i
        self.cache: dict[str, tuple] = {}
        self.held = 0

    def _symbol(self, text: str) -> int | None:
        if text in self.id_of:
            return self.id_of[text]
        return len(self.piece) + ord(text) if len(text) == 1 else None

    def _index(self, pairs: np.ndarray) -> None:
        """A sparse hash table of the pairs: looking one up is mostly a single probe."""
        bits = max(8, int(8 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        slots = ((pairs.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64).tolist()
        self.pair = np.full((1 << bits) + len(pairs) + 1, -1, dtype=np.int64)
        self.place = np.full(len(self.pair), len(pairs), dtype=np.int64)
        for i, (slot, pair) in enumerate(zip(slots, pairs.tolist())):
            while self.pair[slot] >= 0:
                slot += 1
            self.pair[slot], self.place[slot] = pair, i

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of pairs of symbols; ``NO_RANK`` and -1 where they do not merge."""
        keys = left << 22 | right
        slot = ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)
        other = np.flatnonzero((self.pair[slot] != keys) & (self.pair[slot] >= 0))
        while len(other):
            slot[other] += 1
            there = self.pair[slot[other]]
            other = other[(there != keys[other]) & (there >= 0)]
        place = self.place[slot]
        return self.rank[place], self.product[place]

    def merge(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the symbols of many segments until no pair remains.

        Each round finds the smallest pair rank of every segment and merges its
        leftmost non-overlapping occurrences in all segments at once. Where a
        product could at once form a pair of the same or a smaller rank, which
        one-by-one merging would take next, only the leftmost one is merged.
        Segments without pairs leave the arrays. Returns symbols and segments.
        """
        done_symbols, done_segments = [], []
        while len(symbols):
            same = segment[1:] == segment[:-1]
            rank, product = self._ranks(symbols[:-1], symbols[1:])
            rank[~same] = NO_RANK
            starts = np.flatnonzero(np.r_[True, ~same])
            local = np.cumsum(np.r_[0, ~same])
            least = np.minimum.reduceat(np.r_[rank, NO_RANK], starts)
            live = least < NO_RANK
            alive = live[local]
            if not live.all():
                done_symbols.append(symbols[~alive])
                done_segments.append(segment[~alive])
                if not live.any():
                    break
                symbols, segment, local = symbols[alive], segment[alive], local[alive]
                rank, product = rank[alive[:-1]], product[alive[:-1]]
                if len(rank) == len(symbols):
                    rank, product = rank[:-1], product[:-1]
                rank[local[1:] != local[:-1]] = NO_RANK
            best = rank == least[local[:-1]]
            at = np.flatnonzero(best & (rank < NO_RANK))
            # of overlapping occurrences every second one, from the left
            run = np.r_[True, np.diff(at) != 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            made, own = product[at], local[at]
            # pairs that a product forms with what stands beside it at its turn
            merged_left = np.r_[False, (at[1:] == at[:-1] + 2) & (own[1:] == own[:-1])]
            has_left = (at > 0) & (local[np.maximum(at - 1, 0)] == own)
            left = np.where(merged_left, np.r_[0, made[:-1]], symbols[np.maximum(at - 1, 0)])
            beyond = np.minimum(at + 2, len(symbols) - 1)
            has_right = (at + 2 < len(symbols)) & (local[beyond] == own)
            near = np.minimum(
                np.where(has_left, self._ranks(left, made)[0], NO_RANK),
                np.where(has_right, self._ranks(made, symbols[beyond])[0], NO_RANK),
            )
            clash = np.zeros(len(least), dtype=bool)
            clash[own[near <= least[own]]] = True
            keep = ~clash[own] | np.r_[True, own[1:] != own[:-1]]
            at, made = at[keep], made[keep]
            symbols[at] = made
            left_over = np.ones(len(symbols), dtype=bool)
            left_over[at + 1] = False
            symbols, segment = symbols[left_over], segment[left_over]
        if not done_symbols:
            return symbols, segment
        symbols, segment = np.concatenate(done_symbols), np.concatenate(done_segments)
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in which spaces are already marked, flat, and where each text's end."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        if not len(points):
            return np.empty(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        word = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        symbols = self.char_id[points]
        symbols = np.where(symbols < 0, self.n + points, symbols)
        # no piece holds these two characters side by side: nothing merges across
        pairs = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.follows, pairs), len(self.follows) - 1)
        cut = (word[1:] != word[:-1]) | (self.follows[at] != pairs)
        segment = np.cumsum(np.r_[0, cut])
        symbols, segment = self.merge(symbols, segment)
        word = word[np.flatnonzero(np.r_[True, cut])][segment]
        unknown = np.flatnonzero(symbols >= self.n)
        if len(unknown):
            times = np.ones(len(symbols), dtype=np.int64)
            put = [self._unknown(int(s) - self.n) for s in symbols[unknown]]
            times[unknown] = list(map(len, put))
            starts = np.cumsum(times) - times
            symbols, word = np.repeat(symbols, times), np.repeat(word, times)
            for start, ids in zip(starts[unknown].tolist(), put):
                symbols[start : start + len(ids)] = ids
        return symbols, np.searchsorted(word, np.arange(len(texts)), side="right")

    def _unknown(self, point: int) -> list[int]:
        """Ids of a character without a piece: its bytes, or the unknown id."""
        return [self.byte_id[b] for b in chr(point).encode()] if self.byte_id else [self.unknown]

    def pieces_of(self, units: list[str]) -> list[tuple]:
        """For each unit its number of ids, the ids joined by a space, their text, and the ids as bytes."""
        if self.held > CACHE:
            self.cache, self.held = {}, 0
        found = [self.cache.get(u) for u in units]
        lacking = [k for k, known in enumerate(found) if known is None]
        if lacking:
            ids, ends = self.encode_words([units[k] for k in lacking])
            plain = np.add.reduceat(np.r_[self.byte_of[ids] >= 0, False], np.r_[0, ends[:-1]]) == 0
            flat = ids.tolist()
            names, pieces = [self.name[i] for i in flat], [self.shown[i] for i in flat]
            raw, a = ids.astype("<i4").tobytes(), 0
            for k, b, simple in zip(lacking, ends.tolist(), plain.tolist()):
                text = "".join(pieces[a:b]) if simple else self.surface(flat[a:b])
                found[k] = b - a, " ".join(names[a:b]), text, raw[4 * a : 4 * b]
                if len(units[k]) <= LONGEST:
                    self.cache[units[k]] = found[k]
                    self.held += ENTRY + 8 * len(units[k]) + 10 * (b - a)
                a = b
        return found

    def surface(self, ids: list[int]) -> str:
        """Text of some ids, with the leading space still on it."""
        out, held = [], bytearray()
        for i in ids:
            if self.byte_of[i] >= 0:
                held.append(int(self.byte_of[i]))
                continue
            if held:
                out.append(utf8(bytes(held)))
                held = bytearray()
            out.append(self.shown[i])
        if held:
            out.append(utf8(bytes(held)))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, the end id last."""
        if not text:
            return [self.end]
        return [*self.encode_words([SPACE + text.replace(" ", SPACE)])[0].tolist(), self.end]

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: marked spaces as spaces, without the one put in front."""
        text = self.surface(ids)
        first = next((i for i in ids if not self.control[i]), self.end)
        return text[1:] if self.piece[first].startswith(SPACE) else text


def utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a character becomes a mark."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def model_of(data: bytes) -> PieceModel:
    """A model from the content of its file; one for each worker."""
    return PieceModel(data)


def model_at(path: str) -> PieceModel:
    return model_of(Path(path).read_bytes())


UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def encode_chunk(model: PieceModel, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """The distinct units of some texts as ``pieces_of`` gives them, the units of all texts, and where each text's end.

    Equal words of a chunk are merged once.
    """
    units, ends = [], []
    for text in texts:
        if text:
            units += UNITS.findall(SPACE + text.replace(" ", SPACE))
        ends.append(len(units))
    index: dict[str, int] = {}
    codes = np.array([index.setdefault(u, len(index)) for u in units], dtype=np.int64)
    return model.pieces_of(list(index)), codes, np.array(ends, dtype=np.int64)


def texts_of(known: list[tuple], part: int, codes: np.ndarray, ends: np.ndarray, between: str) -> list[str]:
    """One of the texts of the units, joined for each text of the chunk."""
    own, flat, a, out = [k[part] for k in known], codes.tolist(), 0, []
    for b in ends.tolist():
        out.append(between.join([own[c] for c in flat[a:b]]))
        a = b
    return out


def ids_of(model: PieceModel, known: list[tuple], codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts of the chunk, the end id after each, and offsets of the texts."""
    sizes = np.fromiter((k[0] for k in known), np.int64, len(known))
    ids = np.frombuffer(b"".join([k[3] for k in known]), "<i4")
    starts = np.cumsum(sizes) - sizes
    # a text's end is one more unit, of the last id
    ids = np.r_[ids, np.int32(model.end)]
    sizes, starts = np.r_[sizes, 1], np.r_[starts, len(ids) - 1]
    every = np.insert(codes, ends, len(known))
    size = sizes[every]
    until = np.cumsum(size)
    flat = ids[np.repeat(starts[every] - until + size, size) + np.arange(until[-1])] if len(every) else ids[:0]
    return flat.astype(np.int32), np.r_[0, until[ends + np.arange(len(ends))]] if len(ends) else np.zeros(1, np.int64)


def encode(docs: DataFrame, path: str, column: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``ids`` (an array, the end id last) and ``decoded``.

    Null and empty texts have the end id alone and decode to the empty text.
    Clashing input columns named ``ids`` or ``decoded`` are replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("ids", "decoded")]
    df = docs.select(F.struct(*kept).alias("row"), whole(column).alias("text"))
    out = df.select("row", F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema
    data = shipped(docs.sparkSession, path)

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        model = model_of(data.value)
        known, codes, ends = encode_chunk(model, chunk.column("text").to_pylist())
        ids, offsets = ids_of(model, known, codes, ends)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        decoded = [t[1:] for t in texts_of(known, 2, codes, ends, "")]
        return pa.RecordBatch.from_arrays(
            [chunk.column("row"), lists, pa.array(decoded, pa.string())], names=["row", "ids", "decoded"]
        )

    return df.mapInArrow(over_chunks(work, "text"), out).select("row.*", "ids", "decoded")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, number of ids, digests of the ids and of the decoded text.

    Null and empty texts have the end id alone. Repeated rows and null ids are rows
    like others, no rows give no rows, other columns are not looked at. The model's
    file is sent to the tasks; a worker remembers words up to ``CACHE`` bytes.
    """
    data = shipped(docs.sparkSession, path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    sha = lambda texts: [hashlib.sha256(t.encode()).hexdigest() for t in texts]

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        model = model_of(data.value)
        known, codes, ends = encode_chunk(model, chunk.column("text").to_pylist())
        sizes = np.fromiter((k[0] for k in known), np.int64, len(known))
        n = np.diff(np.r_[0, np.r_[0, np.cumsum(sizes[codes])][ends]]) + 1
        ids = [f"{t} {model.end}" if t else str(model.end) for t in texts_of(known, 1, codes, ends, " ")]
        decoded = [t[1:] for t in texts_of(known, 2, codes, ends, "")]
        return pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(sha(ids), pa.string()),
                pa.array(sha(decoded), pa.string()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInArrow(over_chunks(work, "text"), schema)
