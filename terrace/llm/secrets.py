"""Secret scans through nested encodings: a worklist of decoded layers with span mapping."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import over_chunks, whole

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of [0-9a-f] are maximal, so shorter ones just fail

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9_-]{16,}={0,2}")
ALPHABETS = ("A-Za-z0-9+/_-", "A-Za-z0-9+/", "A-Za-z0-9_-")  # a run may be joined to words by characters of the other
RUNS = [re.compile(rf"[{a}]{{16,}}={{0,2}}") for a in ALPHABETS]
NEXT = [re.compile(rf"[ \t]*(?:\r\n?|\n)[ \t]*([{a}]*={{0,2}})") for a in ALPHABETS]
UNPRINTABLE = re.compile("[\x00-\x08\x0e-\x1f\x7f�\udc80-\udcff]")  # the last are bytes that are not UTF-8
SHOWN = re.compile("[^\x00-\x08\x0e-\x1f\x7f�\udc80-\udcff]{12,}")  # no secret is shorter, however encoded
UNPACKED = 16 << 20  # bytes of unpacked content that are scanned at a time
OVERLAP = 1 << 16  # bytes that a part repeats of the one before
LONGEST = 64 << 20  # bytes of a run that is not cut between two parts
BREAK = re.compile(rb"[\x00-\x20!-*,.:-@\[-^`{-\x7f]")  # a byte that no run of characters can hold
STEP, OUT = 1 << 10, 1 << 16  # bytes that are unpacked at a time, and that may come out
DICTIONARY = 256 << 20  # bytes of memory that unpacking xz may take

# Runs that start like packed bytes of which some are percent-encoded, or escaped as in source code.
STARTS = (rb"\x1f\x8b", rb"x[\x01\x5e\x9c\xda]", rb"BZh[1-9]1AY&SY", rb"\xfd7zXZ\x00")
PACKED = re.compile(b"(?:%s)" % b"|".join(STARTS), re.DOTALL)
URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~*!'()/$&,:;=@+^-])+")
ESCAPES = r"""\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[\\abtnvfr0'"]"""
CODE_RUNS = [  # between quotes of either kind
    re.compile(rf"(?:[^\x00-\x1f\x7f-\U0010ffff\\{quote}]|{ESCAPES})+") for quote in "'\""
]
URL_UNIT = re.compile(r"%[0-9A-Fa-f]{2}|.", re.DOTALL)
CODE_UNIT = re.compile(r"\\x..|\\u....|\\.|.", re.DOTALL)
NAMED = dict(zip(b"\\abtnvfr0'\"", b"\\\a\b\t\n\v\f\r\0'\""))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the secrets that a text shows as it stands."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


@dataclass
class Layer:
    """A decoded text; ``start`` and ``end`` give the origin of each of its characters."""

    text: str
    start: np.ndarray | None  # None: the characters stand for themselves
    end: np.ndarray | None
    path: tuple[str, ...] = ()

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a]), int(self.end[b - 1])

    def child(self, parts: list[tuple[str, int, int, bool]], how: str) -> Layer:
        """The layer made of parts: text, origin in this layer, whether characters map one by one."""
        start, end = [], []
        for text, a, b, same in parts:
            if same:
                at = np.arange(a, b)
                start.append(at if self.start is None else self.start[a:b])
                end.append(at + 1 if self.end is None else self.end[a:b])
            else:
                x, y = self.origin(a, b)
                start.append(np.broadcast_to(np.int64(x), len(text)))
                end.append(np.broadcast_to(np.int64(y), len(text)))
        if len(parts) == 1:
            return Layer(parts[0][0], start[0], end[0], (*self.path, how))
        return Layer("".join(p[0] for p in parts), np.concatenate(start), np.concatenate(end), (*self.path, how))


def in_place(layer: Layer, pattern: re.Pattern, decode, how: str) -> Iterator[Layer]:
    """The layer with all runs of a pattern decoded, if there is one."""
    parts, last = [], 0
    for m in pattern.finditer(layer.text):
        a = m.start()
        parts.append((layer.text[last:a], last, a, True))
        for text, length in decode(m[0]):
            parts.append((text, a, a + length, False))
            a += length
        last = m.end()
    if last:
        parts.append((layer.text[last:], last, len(layer.text), True))
        yield layer.child(parts, how)


def percent(run: str) -> list[tuple[str, int]]:
    """Characters of a percent-encoded run with the lengths they take up; bytes that are not UTF-8 are "�"."""
    text = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")
    return [("�", 3) if "\udc80" <= c <= "\udcff" else (c, 3 * len(c.encode())) for c in text]


def escapes(run: str) -> list[tuple[str, int]]:
    """Characters of a run of Unicode escapes; surrogate pairs are one character, what is none is "�"."""
    out: list[tuple[str, int]] = []
    for m in ESCAPED.finditer(run):
        point = int(m[1] or m[2] or m[3], 16)
        if 0xDC00 <= point < 0xE000 and out and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, length = out.pop()
            out.append((chr(0x10000 + (ord(high) - 0xD800 << 10) + point - 0xDC00), length + 6))
        else:
            out.append((chr(point) if point <= 0x10FFFF else "�", m.end() - m.start()))
    return [("�" if 0xD800 <= ord(c) < 0xE000 else c, n) for c, n in out]


def packed(raw: bytes) -> str | None:
    """How some bytes are packed, told by how they start; None if they are not."""
    if raw[:2] == b"\x1f\x8b":
        return "gzip"
    if raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return "zlib"
    if raw[:3] == b"BZh" and raw[3:4] in b"123456789":
        return "bz2"
    return "xz" if raw[:6] == b"\xfd7zXZ\0" else None


class Inflate:
    """Unpacks one member; ``rest`` is what follows it, once it has ended."""

    def __init__(self, how: str):
        self.bits = {"gzip": 31, "zlib": 15, "deflate": -15}.get(how)
        if self.bits:
            self.made = zlib.decompressobj(wbits=self.bits)
        else:
            self.made = bz2.BZ2Decompressor() if how == "bz2" else lzma.LZMADecompressor(lzma.FORMAT_XZ, DICTIONARY)
        self.broken, self.rest = False, b""

    @property
    def ended(self) -> bool:
        return self.made.eof

    def feed(self, data: bytes) -> Iterator[bytes]:
        """What comes out, ``OUT`` bytes at a time; up to a fault, if there is one."""
        while True:
            before = self.made.copy() if self.bits else None
            try:
                out = self.made.decompress(data, OUT)
            except (zlib.error, lzma.LZMAError, OSError, EOFError):
                self.broken = True
                if before:
                    yield up_to_fault(before, data)
                return
            if out:
                yield out
            if self.made.eof:
                self.rest = self.made.unused_data
                return
            data = self.made.unconsumed_tail if self.bits else b""
            if not data and (self.bits or self.made.needs_input):
                return

    def last(self) -> bytes:
        return self.made.flush() if self.bits else b""


def unpack(parts: Iterable[bytes], how: str | None = None) -> Iterator[bytes]:
    """The content of packed bytes: all members, and of a broken one what comes before its fault.

    ``how`` is for a first member that does not tell.
    """
    made, data = Inflate(how) if how else None, b""
    for part in parts:
        data += part
        while data:
            if made is None:
                data = data.lstrip(b"\0")  # between members
                kind = packed(data)
                if kind is None:
                    if len(data) < 6:
                        break
                    return
                made = Inflate(kind)
            yield from made.feed(data)
            if made.broken:
                return
            data = made.rest if made.ended else b""
            made = None if made.ended else made
    if made is not None:
        yield made.last()


def up_to_fault(made, data: bytes) -> bytes:
    out = bytearray()
    try:
        while data and not made.eof:
            out += made.decompress(data, 1)
            data = made.unconsumed_tail
    except zlib.error:
        pass
    return bytes(out)


def bare_deflate(raw: bytes) -> bool:
    """Whether bytes are one deflate stream without a header, from first to last."""
    made = Inflate("deflate")
    size = 0
    for i in range(0, len(raw), STEP):
        if made.ended:
            return False
        size += sum(map(len, made.feed(raw[i : i + STEP])))
        if made.broken:
            return False
    return made.ended and not made.rest and size >= 12


def in_parts(content: Iterable[bytes]) -> Iterator[bytes]:
    """Content in parts of ``UNPACKED`` bytes or somewhat more, each with the last ``OVERLAP`` bytes of the one before.

    A part ends where no run of letters and digits goes on, so that a run is whole
    in one part; only one longer than ``LONGEST`` is cut. What spreads over such
    an end, like a name and its value, is whole in the next part.
    """
    held, sought = bytearray(), 0
    for some in content:
        held += some
        if len(held) >= UNPACKED + OVERLAP:
            cut = 0
            for m in BREAK.finditer(held, max(sought, OVERLAP)):
                cut = m.end()
            sought = len(held)
            if cut or len(held) >= LONGEST:
                cut = cut or len(held)
                yield bytes(held[:cut])
                del held[: cut - OVERLAP]
                sought = 0
    if held:
        yield bytes(held)


def printable(raw: bytes) -> str | None:
    """Bytes as text, if any of it may hold a secret; what is no printable character is a null character."""
    text = raw.decode("utf-8", "surrogateescape")
    return UNPRINTABLE.sub("\0", text) if SHOWN.search(text) else None


def contents(raw: bytes, all_: bool, how: str = "base64") -> Iterator[tuple[str, str]]:
    """The texts that decoded bytes show, and how: themselves, then (for ``all_``) what they unpack to, again and again.

    A part of the content that came before is not given again.
    """
    if how == "base64" and (shown := printable(raw)):
        yield shown, how
    make, seen = lambda: (raw[i : i + STEP] for i in range(0, len(raw), STEP)), set()
    start, whole_ones = raw[:6], set()
    kind = packed(start) or ("deflate" if all_ and how == "base64" and bare_deflate(raw) else None)
    while all_ and kind:
        make, how = partial(unpacked, make, kind), how + "+unpack"
        start, digest = b"", hashlib.sha256()

        def noted(content: Iterator[bytes]) -> Iterator[bytes]:
            nonlocal start
            for some in content:
                start = start if len(start) >= 6 else start + some[:6]
                digest.update(some)
                yield some

        for part in in_parts(noted(make())):
            mark = hashlib.sha256(part).digest()
            if mark not in seen and (shown := printable(part)):
                yield shown, how
            seen.add(mark)
        if digest.digest() in whole_ones:  # what unpacks to itself
            break
        whole_ones.add(digest.digest())
        kind = packed(start)


def unpacked(make: Callable[[], Iterator[bytes]], how: str) -> Iterator[bytes]:
    return unpack((some[i : i + STEP] for some in make() for i in range(0, len(some), STEP)), how)


def code_byte(unit: str) -> int:
    """The byte of a character or an escape as in source code."""
    if unit[0] != "\\":
        return ord(unit)
    return int(unit[-2:], 16) if unit[1] in "xu" else NAMED[ord(unit[1])]


def url_byte(unit: str) -> int:
    return int(unit[1:], 16) if unit[0] == "%" else ord(unit)


def form_byte(unit: str) -> int:
    return 32 if unit == "+" else url_byte(unit)


def extent(raw: bytes) -> int:
    """How many of some bytes are packed members, from the first."""
    at = 0
    while (kind := packed(raw[at : at + 6])) is not None:
        made, i = Inflate(kind), at
        while i < len(raw) and not made.ended and not made.broken:
            for _ in made.feed(raw[i : i + STEP]):
                pass
            i += STEP
        if not made.ended:
            return len(raw)
        at = min(i, len(raw)) - len(made.rest)
    return at


def packed_runs(layer: Layer) -> Iterator[Layer]:
    """What percent-encoded or escaped bytes unpack to, as parts that come from all of these bytes."""
    for mark, pattern, unit, byte, how in (
        ("%", URL_RUN, URL_UNIT, url_byte, "url"),
        ("%", URL_RUN, URL_UNIT, form_byte, "url"),
        *(("\\", run, CODE_UNIT, code_byte, "unicode") for run in CODE_RUNS),
    ):
        if mark not in layer.text:
            continue
        for m in pattern.finditer(layer.text):
            if mark not in m[0]:
                continue
            units = unit.findall(m[0])
            raw = bytes(map(byte, units))
            for at in PACKED.finditer(raw):
                some = raw[at.start() :]
                a = m.start() + sum(map(len, units[: at.start()]))
                b = a + sum(map(len, units[at.start() : at.start() + extent(some)]))
                if a < b:
                    for shown, way in contents(some, True, how):
                        yield layer.child([(shown, a, b, False)], way)


def runs(text: str) -> Iterator[tuple[tuple[int, int], ...]]:
    """Runs that may be base64, each once, as the spans of their lines.

    They are maximal over both alphabets and over each one. Lines of equal
    length that follow each other are a run together, with and without the
    shorter line after them, and each is one alone.
    """
    seen = set()
    for run, more in zip(RUNS, NEXT):
        joined_to = 0
        for m in run.finditer(text):
            found = [(m.span(),)]
            if m.start() >= joined_to and m[0][-1] != "=":
                found += wrapped(text, m.span(), more)
                joined_to = found[-1][-1][1] if len(found) > 1 else 0
            for lines in found:
                if lines not in seen:
                    seen.add(lines)
                    yield lines
    for m in BASE64.finditer(text):
        if (m.span(),) not in seen:
            yield (m.span(),)


def wrapped(text: str, first: tuple[int, int], more: re.Pattern) -> list[tuple[tuple[int, int], ...]]:
    """Runs of several lines from a first one: with the shorter line at the end, and last those of equal length."""
    lines, width = [first], first[1] - first[0]
    while (m := more.match(text, lines[-1][1])) and len(m[1].rstrip("=")) == len(m[1]) == width:
        lines.append(m.span(1))
    out = []
    if m and m[1] and len(m[1].rstrip("=")) <= width:
        out.append((*lines, m.span(1)))
    return out + [tuple(lines)] if len(lines) > 1 or out else out


def decoded(layer: Layer) -> Iterator[Layer]:
    """All layers that are one decoding away."""
    text = layer.text
    if "%" in text:
        yield from in_place(layer, PERCENT, percent, "url")
    if "\\" in text:
        yield from in_place(layer, ESCAPE, escapes, "unicode")
    yield from packed_runs(layer)
    every, longest = list(runs(text)), {}
    for lines in every:
        longest[lines[0][0]] = max(longest.get(lines[0][0], 0), lines[-1][1])
    for lines in every:
        run = "".join(text[a:b] for a, b in lines).rstrip("=")
        run = run[: len(run) - (len(run) % 4 == 1)]
        try:
            raw = base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4), validate=True)
        except binascii.Error:
            continue
        # of runs with the same start the longest unpacks to all that the others do
        for shown, how in contents(raw, lines[-1][1] == longest[lines[0][0]]):
            if how == "base64":
                yield in_groups(layer, lines, shown, raw)
            else:
                yield layer.child([(shown, lines[0][0], lines[-1][1], False)], how)


def in_groups(layer: Layer, lines: tuple[tuple[int, int], ...], shown: str, raw: bytes) -> Layer:
    """The layer of a base64 run that is not compressed: characters come from the groups of four that hold their bytes."""
    codes = np.frombuffer(raw.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
    stray = (codes >= 0xDC80) & (codes <= 0xDCFF)  # one byte each
    ends = np.cumsum(np.where(stray, 1, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)))
    firsts = np.r_[0, ends[:-1]]
    at = np.concatenate([np.arange(a, b) for a, b in lines])
    start, end = at[firsts // 3 * 4], at[np.minimum((ends - 1) // 3 * 4 + 3, len(at) - 1)] + 1
    if layer.start is not None:
        start, end = layer.start[start], layer.end[end - 1]
    return Layer(shown, start, end, (*layer.path, "base64"))


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, str, str]]]:
    """Base spans of a text, and all spans with the value found and the way to it.

    The worklist holds layers not yet scanned; one whose text and origin were
    seen before is not taken again, so cycles end. A span found in a layer is
    given as the part of the text that its characters were decoded from.
    """
    base = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))
    spans = {(a, b, k, text[a:b]): "" for a, b, k in base}
    work, seen = deque([Layer(text, None, None)]), {hash_of(text, 0, len(text))}
    while work:
        layer = work.popleft()
        for new in decoded(layer):
            if not new.text:
                continue
            mark = hash_of(new.text, int(new.start[0]), int(new.end[-1]))
            if mark in seen:
                continue
            seen.add(mark)
            for a, b, kind in base_spans(new.text):
                x, y = new.origin(a, b)
                spans.setdefault((x, y, kind, new.text[a:b]), ">".join(new.path))
            work.append(new)
    every = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return base, [(*s, spans[s]) for s in every]


def hash_of(text: str, a: int, b: int) -> bytes:
    return hashlib.sha256(f"{a}:{b}:{text}".encode("utf-8", "surrogatepass")).digest()


def joined(spans: list[tuple]) -> str:
    """kind:start:end of each span, once also where it hides several values."""
    return ",".join(dict.fromkeys(f"{s[2]}:{s[0]}:{s[1]}" for s in spans))


def scan_documents(docs: DataFrame, column: str = "text") -> DataFrame:
    """One row per secret: doc_id, kind, start, end, value, and the decodings on the way to it.

    Null and empty texts have none, a table without rows gives no rows. Rows with a
    null or repeated doc_id are scanned like any other; all other columns are
    ignored. A text of any length is scanned whole, and what it unpacks to in parts.
    """
    schema = "doc_id long, kind string, start int, end int, value string, way string"

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            {"doc_id": i, "kind": k, "start": a, "end": b, "value": value, "way": way}
            for i, text in zip(chunk.column("doc_id").to_pylist(), chunk.column("text").to_pylist())
            for a, b, k, value, way in scan(text)[1]
        ]
        types = {"doc_id": pa.int64(), "kind": pa.string(), "start": pa.int32()}
        types |= {"end": pa.int32(), "value": pa.string(), "way": pa.string()}
        return pa.RecordBatch.from_pylist(rows, pa.schema(types.items()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(column).alias("text"))
    return rows.mapInArrow(over_chunks(work, "text"), schema)


def scan_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts and digest of the base spans, and all spans as text.

    Null and empty texts have none, rows that repeat are each scanned, no rows give
    no rows, other columns are ignored.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def work(chunk: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [], [], []
        for text in chunk.column("text").to_pylist():
            base, every = scan(text)
            kinds = [s[2] for s in base]
            counts.append([kinds.count(k) for k in KINDS])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(every))
        numbers = [pa.array(list(n), pa.int64()) for n in zip(*counts)]
        return pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInArrow(over_chunks(work, "text"), schema)
