"""An n-gram trie whose levels are Elias-Fano sequences in one memory map."""

from __future__ import annotations

import mmap

import numpy as np

SAMPLE = 1024  # every so many elements of a sequence have a known place
CODES = 4096  # values a level's probabilities are quantised to
BLOCK = 1 << 18  # elements decoded at a time


def bits_of(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, packed."""
    if not width or not len(values):
        return np.empty(0, dtype=np.uint8)
    raw = values.astype("<u8").view(np.uint8).reshape(len(values), 8)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :width].ravel(), bitorder="little")


def packed(values: np.ndarray, width: int) -> np.ndarray:
    """``bits_of`` in steps, so that the unpacked bits stay small."""
    step = BLOCK  # a multiple of 8: each step ends at a byte
    return np.concatenate([bits_of(values[i : i + step], width) for i in range(0, max(1, len(values)), step)])


def unpacked(raw: np.ndarray, width: int, a: int, b: int) -> np.ndarray:
    """The values from place ``a`` to ``b`` of what ``packed`` made."""
    if not width or b <= a:
        return np.zeros(max(0, b - a), dtype=np.uint64)
    first = a * width // 8
    bits = np.unpackbits(raw[first : (b * width + 7) // 8], bitorder="little")
    bits = bits[a * width - first * 8 :][: (b - a) * width].reshape(b - a, width)
    whole = np.zeros((b - a, 64), dtype=np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u8").ravel()


def monotone(values: np.ndarray) -> dict[str, np.ndarray]:
    """Elias-Fano form of values that do not fall: low bits packed, high bits in unary."""
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // max(1, n)).bit_length() - 1)
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high = np.zeros((int(places[-1]) // 8 + 1) if n else 0, dtype=np.uint8)
    np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
    return {"size": np.array([n, width]), "low": packed(values, width), "high": high, "sample": places[::SAMPLE]}


class Sequence:
    """Reads an Elias-Fano sequence."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.width = map(int, parts["size"])
        self.low, self.high, self.sample = parts["low"], parts["high"], parts["sample"]

    def slice(self, a: int, b: int) -> np.ndarray:
        """Elements from place ``a`` up to ``b``."""
        if b <= a:
            return np.empty(0, dtype=np.uint64)
        first = a // SAMPLE
        start = int(self.sample[first]) // 8
        last = (b - 1) // SAMPLE + 1
        end = int(self.sample[last]) // 8 + 1 if last < len(self.sample) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:end], bitorder="little")) + start * 8
        ones = ones[np.searchsorted(ones, self.sample[first]) :]
        place = np.arange(a, b)
        high = ones[a - first * SAMPLE : b - first * SAMPLE] - place
        return (high.astype(np.uint64) << np.uint64(self.width)) | unpacked(self.low, self.width, a, b)


def quantised(values: np.ndarray) -> dict[str, np.ndarray]:
    """Values as codes into a book of at most ``CODES`` of their quantiles."""
    book = np.unique(values)
    if len(book) > CODES:
        book = np.unique(np.quantile(values, (np.arange(CODES) + 0.5) / CODES))
    middle = (book[1:] + book[:-1]) / 2
    return {"code": np.searchsorted(middle, values).astype(np.uint16), "book": book.astype(np.float64)}


def mapped(arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The same arrays as views of one anonymous memory map."""
    starts, at = {}, 0
    for name, x in arrays.items():
        starts[name] = at
        at += -(-x.nbytes // 8) * 8
    memory = mmap.mmap(-1, max(8, at))
    out = {}
    for name, x in arrays.items():
        view = np.frombuffer(memory, dtype=x.dtype, count=len(x), offset=starts[name])
        view[:] = x
        out[name] = view
    return out


class Trie:
    """Words at the first level, and below each one the contexts it was seen in.

    It holds reversed bigrams: the path to a token after a context is first the
    token, then the context. Both levels carry quantised values. Contexts are
    stored relative to the last one of the word before, so that the level as a
    whole is monotone and one search finds a context among a word's own.
    """

    def __init__(self, words: np.ndarray, word_values: np.ndarray, first: np.ndarray, contexts: np.ndarray, values: np.ndarray):
        """``words`` ascending; ``contexts`` ascending within each word, whose first is at ``first``."""
        ends = np.r_[first[1:], len(contexts)].astype(np.int64)
        own = np.repeat(np.arange(len(words)), ends - first)
        last = contexts[ends - 1].astype(np.uint64) + np.uint64(1) if len(words) else np.empty(0, dtype=np.uint64)
        base = np.r_[np.zeros(1, dtype=np.uint64), np.cumsum(last, dtype=np.uint64)[:-1]] if len(words) else last
        levels = {
            "words": monotone(words),
            "pointers": monotone(np.r_[first, len(contexts)].astype(np.uint64)),
            "contexts": monotone(contexts.astype(np.uint64) + base[own]),
            "word": quantised(word_values),
            "value": quantised(values),
        }
        flat = mapped({f"{level}.{name}": x for level, parts in levels.items() for name, x in parts.items()})
        part = lambda level: {k.split(".")[1]: v for k, v in flat.items() if k.startswith(f"{level}.")}
        self.words, self.pointers, self.contexts = (Sequence(part(x)) for x in ("words", "pointers", "contexts"))
        self.word, self.value = part("word"), part("value")
        self.nbytes = sum(x.nbytes for x in flat.values())

    def look_up(self, words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Queries in ascending order: whether the word and the pair are known, and their values.

        The levels are decoded block by block, each query meeting its own block.
        """
        n = len(words)
        has_word, has_pair = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        word_value, value = np.zeros(n), np.zeros(n)
        step = BLOCK // 4
        for a in range(0, self.words.n, step):
            b = min(self.words.n, a + step)
            known = self.words.slice(a, b)
            x, y = np.searchsorted(words, known[0]), np.searchsorted(words, known[-1], side="right")
            if x == y:
                continue
            at = np.searchsorted(known, words[x:y])
            hit = known[np.minimum(at, len(known) - 1)] == words[x:y]
            place, node = np.flatnonzero(hit) + x, at[hit]
            has_word[place] = True
            word_value[place] = self.word["book"][self.word["code"][a + node]]
            pointers = self.pointers.slice(a, b + 1).astype(np.int64)
            self._pairs(place, pointers, node, contexts, has_pair, value)
        return has_word, has_pair, word_value, value

    def _pairs(self, place, pointers, node, contexts, has_pair, value) -> None:
        """Successor search for the queries at ``place`` among the contexts of their ``node``."""
        cuts = np.searchsorted(pointers, np.arange(pointers[0], pointers[-1], BLOCK))
        cuts = np.unique(np.r_[cuts, len(pointers) - 1])
        for p, q in zip(cuts[:-1], cuts[1:]):
            x, y = np.searchsorted(node, p), np.searchsorted(node, q)
            if x == y:
                continue
            start = int(pointers[p])
            before = self.contexts.slice(start - 1, start)[0] + np.uint64(1) if start else np.uint64(0)
            level = self.contexts.slice(start, int(pointers[q]))
            first = pointers[node[x:y]] - start
            base = np.where(first > 0, level[np.maximum(first - 1, 0)] + np.uint64(1), before)
            wanted = base + contexts[place[x:y]].astype(np.uint64)
            found = np.searchsorted(level, wanted)
            inside = found < pointers[node[x:y] + 1] - start
            hit = inside & (level[np.minimum(found, len(level) - 1)] == wanted)
            has_pair[place[x:y][hit]] = True
            value[place[x:y][hit]] = self.value["book"][self.value["code"][start + found[hit]]]
