"""Sum-of-squares packing of token ids into windows."""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import shipped, text_chunks, whole

WINDOW = 4096
END = 2  # id put after each document
CACHE = 32 << 20  # bytes of words that a worker keeps
KEPT = 1 << 20  # words that it keeps
BLOCK = 1 << 14  # words that are encoded at once
CHUNK = 8 << 20  # bytes of texts that are encoded at once
# Latin letters that are in composed form and have one lower case letter, and marks
LETTERS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]"
MARKS = r"[!-/:-@\[-`{-~]"
EASY = f"^({LETTERS}+|{MARKS}+)$"
OPEN = 1024  # partly filled windows that a task keeps; beyond, documents are cut into them
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def gathered(ids: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` that some codes stand for, one after the other, and where each ends.

    ``sizes`` has the length of each run in ``ids``.
    """
    starts = np.cumsum(sizes) - sizes
    size = sizes[codes]
    until = np.cumsum(size)
    place = np.repeat(starts[codes] - until + size, size)
    place += np.arange(len(place))
    return ids[place], until


class Words:
    """Ids of words, of which a worker keeps at most ``KEPT`` with at most ``CACHE`` characters.

    When there are more, it forgets those that the latest chunk did without.
    """

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
        from tokenizers import Tokenizer

        settings = json.loads(data)
        self.any = Tokenizer.from_str(data.decode())
        # for words in lower case that are cut from what follows
        settings["normalizer"] = None
        settings["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.plain = Tokenizer.from_str(json.dumps(settings))
        self._keep(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def _keep(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.words, self.sizes, self.known = words, sizes, ids

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct words their codes, and sizes and ids of all codes."""
        codes = pc.index_in(words, value_set=self.words)
        lacking = pc.is_null(codes)
        fresh = words.filter(lacking)
        before = len(self.words)
        if len(fresh):
            easy = pc.match_substring_regex(fresh, EASY)
            for some, encode in ((fresh.filter(easy), self._parts), (fresh.filter(pc.invert(easy)), self._alone)):
                sizes, ids = encode(some.to_pylist())
                words_now = pa.concat_arrays([self.words, some])
                self._keep(words_now, np.r_[self.sizes, sizes], np.r_[self.known, ids])
            codes = pc.index_in(words, value_set=self.words)
        codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
        out = codes, self.sizes, self.known
        if before > KEPT or self.words.nbytes > CACHE:
            ids, _ = gathered(self.known, self.sizes, codes)
            self._keep(words, self.sizes[codes], ids)
        return out

    def _parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words that the vocabulary takes as they are; the library encodes them as parts of one text."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for a in range(0, len(words), BLOCK):
            block = words[a : a + BLOCK]
            found = self.plain.encode(block, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, dtype="<u4"))
            sizes.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(block)))
        return np.concatenate(sizes), np.concatenate(ids)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of other words, each a text of its own."""
        found = [e.ids for e in self.any.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter((i for ids in found for i in ids), "<u4", int(sizes.sum()))


@lru_cache(maxsize=2)
def words_of(data: bytes) -> Words:
    """The words of a vocabulary, from the content of its file; one for each worker."""
    return Words(data)


def token_ids(words: Words, texts: pa.Array, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of some texts, ``end`` after each, and the offsets of the texts.

    The vocabulary drops blanks and never joins what stands on both sides of one,
    nor letters with the marks after them, and has no upper case. So texts are cut
    at spaces and line ends, and Latin words from the marks after them; each
    distinct part is encoded once. All other parts are left to the library whole.
    """
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    pieces = parts.flatten().dictionary_encode()
    distinct = pieces.dictionary
    cut = pc.extract_regex(distinct, f"^(?P<word>{LETTERS}*)(?P<marks>{MARKS}*)$")
    simple = cut.is_valid()
    word = pc.if_else(simple, pc.utf8_lower(pc.struct_field(cut, "word")), distinct)
    marks = pc.if_else(simple, pc.struct_field(cut, "marks"), "")
    halves = pa.concat_arrays([word, marks]).dictionary_encode()
    codes, sizes, known = words.find(halves.dictionary)
    pairs = codes[halves.indices.to_numpy()].reshape(2, -1).T.reshape(-1)
    ids, until = gathered(known, sizes, pairs)
    size = np.diff(until[1::2], prepend=0)
    # the end of a text is one more piece
    ids, size = np.r_[ids, np.uint32(end)], np.r_[size, 1]
    every = np.insert(pieces.indices.to_numpy().astype(np.int64), offsets[1:], len(size) - 1)
    flat, until = gathered(ids, size, every)
    return flat, np.r_[0, until[offsets[1:] + np.arange(len(texts))]]


class Packer:
    """Windows of a task, filled online.

    ``count[h]`` is the number of windows that are filled up to ``h``, for levels
    between 0 and full. A piece goes to the level, or to a new window, that leaves
    the smallest sum of the counts' squares; of equal ones to the fullest.
    """

    def __init__(self, window: int = WINDOW, most_open: int = OPEN):
        self.window, self.most = window, most_open
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.at: dict[int, list[list]] = defaultdict(list)  # per level its windows, each a list of pieces
        self.n_open = 0
        self.full: list[list] = []

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        """Place a document: full windows of its own first, then the rest."""
        start = 0
        while len(ids) - start >= self.window:
            self.full.append([(doc, start, ids[start : start + self.window])])
            start += self.window
        while start < len(ids):
            start += self._place(doc, start, ids[start:])

    def _place(self, doc: tuple, start: int, ids: np.ndarray) -> int:
        """Put a piece into a window, if need be only its beginning; returns how many ids."""
        level = self._level(len(ids))
        if level == 0 and self.n_open >= self.most:
            level = int(self.window - 1 - np.argmax(self.count[1:-1][::-1]))
        piece = ids[: self.window - level].copy()  # a view would keep the ids of its whole chunk
        if level:
            held = self.at[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        else:
            held = []
        held.append((doc, start, piece))
        self._open(level + len(piece), held)
        return len(piece)

    def _open(self, level: int, held: list) -> None:
        if level == self.window:
            self.full.append(held)
        else:
            self.at[level].append(held)
            self.count[level] += 1
            self.n_open += 1

    def _level(self, size: int) -> int:
        """The level at which a piece adds least to the squares; 0 is a new window."""
        room = self.window - size
        n = self.count
        # a window that leaves level h takes 2 n(h) - 1 from the squares, one that comes to h adds 2 n(h) + 1
        change = 2 * (n[size : self.window + 1] - n[: room + 1]) + 2
        change[0] = 2 * n[size] + 1  # a new window leaves no level
        change[room] -= 2 * n[self.window] + 1  # a full one is not counted
        change[1:][n[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return int(room - np.argmin(change[::-1]))

    def closed(self) -> list[list]:
        """The windows that are full by now."""
        out, self.full = self.full, []
        return out

    def rest(self) -> list[list]:
        """The windows that are not full, cut anew so that none needs padding.

        Windows filled to a power of two stay. The others' pieces are laid end to
        end and cut into full windows, and the last less than full one into
        windows whose sizes are powers of two.
        """
        levels = sorted(self.at, reverse=True)
        whole_ones = [w for h in levels if h & (h - 1) == 0 for w in self.at[h]]
        loose = [p for h in levels if h & (h - 1) for w in self.at[h] for p in w]
        left = sum(len(ids) for _, _, ids in loose)
        out, held, room = [], [], 0
        for doc, start, ids in loose:
            while len(ids):
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                    held = []
                    out.append(held)
                piece, ids = ids[:room], ids[room:]
                held.append((doc, start, piece))
                start, room, left = start + len(piece), room - len(piece), left - len(piece)
        self.at.clear()
        self.count[:] = 0
        self.n_open = 0
        return whole_ones + out


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, most_open: int = OPEN) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of at most ``window`` ids.

    Each task packs the rows of its partition by itself, in one pass and without a
    shuffle, so a hot source or a group of copies makes no task larger. It keeps at
    most ``most_open`` partly filled windows; when documents fit into none of them and
    that many are open, they are cut. What is left in the end is cut so that it
    needs no padding: sequences are full or a power of two. Sequences are numbered
    within a partition; a task run again over the same files gives the same.

    A null or empty text has the end id alone; texts may be of any length, and rows
    that repeat or have no doc_id are documents like others. No rows give no rows.
    Other columns are not looked at.
    """
    data = shipped(docs.sparkSession, path)

    def rows_of(windows: list[list], first: int) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        for k, held in enumerate(windows):
            at = 0
            for (doc, tokens), start, ids in held:
                row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, first + k, at)
                for column, x in zip(columns, row):
                    column.append(x)
                at += len(ids)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = words_of(data.value), Packer(window, most_open)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            for chunk in text_chunks(batch, "text", CHUNK):
                ids, offsets = token_ids(words, chunk.column("text"), end)
                for doc, a, b in zip(chunk.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                    packer.add((doc, b - a), ids[a:b])
                done = packer.closed()
                yield rows_of(done, number)
                number += len(done)
        yield rows_of(packer.rest(), number)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInArrow(work, SCHEMA)
