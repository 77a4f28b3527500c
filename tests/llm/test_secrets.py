import base64
import bz2
import gzip
import hashlib
import lzma
import random
import urllib.parse
import zlib

import pytest

from terrace.llm import secrets
from tests.llm.cases import empty, frame, hard

TOKEN = "token=abcdef123456"


def found(text):
    return [(text[a:b], kind, value) for a, b, kind, value, _ in secrets.scan(text)[1]]


@pytest.mark.parametrize(
    "text, base",
    [
        ("Password: hunter22", [(0, 18, "assign")]),
        ("api_key='abc12' apikey=\"abc123\"", [(16, 30, "assign")]),
        ("PASSWD = a.b/c+d", [(0, 16, "assign")]),
        ("secret=shor", []),
        ("toKen=abcdef1", []),
        ("AKIA" + "A" * 16, [(0, 20, "access")]),
        ("AKIA" + "A" * 15, []),
        ("x" + "0123456789abcdef" * 2, [(1, 33, "hex")]),
        ("0123456789abcdef0123456", []),
        ("😀 " + TOKEN, [(2, 20, "assign")]),
        ("", []),
    ],
)
def test_base(text, base):
    assert secrets.scan(text)[0] == base


def test_nested_layers_map_back():
    quoted = urllib.parse.quote(TOKEN)
    assert found(f"see {quoted} there") == [(quoted, "assign", TOKEN)]
    packed = base64.b64encode(gzip.compress(TOKEN.encode())).decode()
    assert found(f"see {packed} there") == [(packed, "assign", TOKEN)]
    packed = base64.b64encode(zlib.compress(base64.b64encode(TOKEN.encode()))).decode()
    assert found(f"see {packed} there") == [(packed, "assign", TOKEN)]
    escaped = "".join(f"\\u{ord(c):04x}" for c in TOKEN)
    assert found(f"see {escaped} there") == [(escaped, "assign", TOKEN)]
    twice = urllib.parse.quote(urllib.parse.quote(TOKEN))
    assert found(f"see {twice} there") == [(twice, "assign", TOKEN)]
    mixed = "tok%65n=abcdef123456"
    assert found(f"see {mixed} there") == [(mixed, "assign", TOKEN)]


def test_runs_in_either_alphabet():
    r = random.Random(1)
    for _ in range(200):
        secret = f"note {r.randbytes(30).hex()[:23]} password=" + "".join(r.choices("abcdefgh0123456789", k=12))
        for raw in (secret.encode(), zlib.compress(secret.encode()), ("ÿ¿þ" * 9 + secret).encode()):
            for code in (base64.urlsafe_b64encode, base64.b64encode):
                run = code(raw).decode().rstrip("=")
                for text in (f"see {run} there", f"see key-{run}" if code is base64.b64encode else f"see a/b/{run}"):
                    assert {v for _, k, v in found(text) if k == "assign"} == {secret[29:]}, text


@pytest.mark.parametrize("between", ["\n", "\r\n", "\n    "])
def test_wrapped_runs(between):
    r = random.Random(2)
    for n in range(60):
        filler = "".join(r.choices("abcdefgh ijklmn", k=150 + n))
        for raw in (gzip.compress(f"{filler} {TOKEN}".encode()), f"{filler} {TOKEN} {filler}".encode()):
            run = between.join(base64.encodebytes(raw).decode().split())
            for text in (f"see\n{run}\n-----END", f"see\n{run}", f"see\n{run}\nthere is more"):
                assert ("assign", TOKEN) in [f[1:] for f in found(text)], text
    run = base64.encodebytes(gzip.compress(r.randbytes(200).hex().encode() + TOKEN.encode())).decode().strip()
    a, b, kind = next(s[:3] for s in secrets.scan(f"see {run} there")[1] if s[2] == "assign")
    assert (a, b) == (4, 4 + len(run))


def test_base_spans_stay_and_plain_text_has_none():
    text = f"{TOKEN} and %41%42"
    base, every = secrets.scan(text)
    assert base == [(0, 18, "assign")] and [s[:3] for s in every] == base
    assert secrets.scan("100%25 of plain words, nothing \\u0041 here")[1] == []


def test_broken_layers_are_left():
    for text in ("%ff%fe", "%4", "\\ud800", "\\U00110000", "A" * 17, "H4sIAAAAAAAA" + "A" * 20):
        assert secrets.scan(text) == ([], [])


def test_cycles_and_bombs_end():
    bomb = base64.b64encode(zlib.compress(b"0" * (secrets.UNPACKED + 1))).decode()
    assert secrets.scan(bomb)[0] == []
    assert secrets.scan("%25" * 1000)[1] == []


def values(raw):
    return {v for _, k, v in found(f"see {base64.b64encode(raw).decode()} there") if k == "assign"}


def test_unclean_layers_are_scanned():
    assert values(b"user=a\0password=hunter2secret") == {"password=hunter2secret"}
    assert values(gzip.compress(f"für José {TOKEN} ".encode("latin-1"))) == {TOKEN}
    assert values(f"some � {TOKEN}".encode()) == {TOKEN}
    assert [f[1:] for f in found("tok%65n%ff%3Dx %ff%74oken=abcdef123456")] == [("assign", TOKEN)]
    escaped = "\\U00110000" + "".join(f"\\u{ord(c):04x}" for c in TOKEN)
    assert [f[2] for f in found(escaped)] == [TOKEN]


def test_broken_and_several_members():
    own = random.Random(4).randbytes(2000).hex()
    whole = gzip.compress(f"{TOKEN} {own}".encode())
    assert values(whole[:-200]) == values(whole[:-8] + b"x" * 8) == {TOKEN}
    for at in range(300, len(whole) - 8, 97):
        assert values(whole[:at] + b"\xff" * 40 + whole[at + 40 :]) == {TOKEN}
    assert values(gzip.compress(b"nothing here") + whole) == {TOKEN}
    assert values(gzip.compress(b"nothing here") + bytes(9) + whole) == {TOKEN}
    assert values(gzip.compress(b"nothing here") + f" {TOKEN}".encode()) == {TOKEN}
    assert values(zlib.compress(gzip.compress(b"nothing here") + whole)) == {TOKEN}


def test_large_content_is_scanned_in_parts(monkeypatch):
    at_end = zlib.compress(b"0 " * (secrets.UNPACKED // 2 + 1) + TOKEN.encode(), 9)
    assert values(at_end) == {TOKEN}
    monkeypatch.setattr(secrets, "UNPACKED", 4096)
    monkeypatch.setattr(secrets, "OUT", 64)
    inner = base64.b64encode(zlib.compress(f"secret=innermost {random.Random(5).randbytes(300).hex()}".encode())).decode()
    for before in range(1900, 4400, 61):
        for hidden, value in ((TOKEN, TOKEN), (inner, "secret=innermost")):
            raw = ("b c " * 1200)[:before] + f" {hidden} " + "d e " * 3000
            assert values(gzip.compress(raw.encode())) == {value}
            assert values(gzip.compress(zlib.compress(raw.encode()))) == {value}


def test_no_part_of_large_content_is_lost(monkeypatch):
    """Blanks and secrets at random places, content many times what is scanned at once."""
    monkeypatch.setattr(secrets, "UNPACKED", 4000)
    monkeypatch.setattr(secrets, "OVERLAP", 200)
    monkeypatch.setattr(secrets, "LONGEST", 12_000)
    monkeypatch.setattr(secrets, "OUT", 300)
    r = random.Random(8)
    for n in range(120):
        parts, want = [], set()
        for k in range(r.randrange(1, 6)):
            filler = r.choice(["x", "ab", "lorem-", "0", "a_b"]) * r.randrange(1, 2500)
            if r.random() < 0.5:
                filler = filler[: len(filler) // 2] + " " + filler[len(filler) // 2 :]
            value = "".join(r.choices("ghijklmnop", k=13))
            form = r.choice(['"password":"%s"', " token = %s ", "{secret: '%s'}", '"api_key":"%s",'])
            parts.append(filler + r.choice(['"', ",", "(", " "]) + form % value)
            want.add(value)
        raw = "".join(parts).encode() + b";" + b"y" * r.randrange(9000)
        for packer in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
            got = " ".join(values(packer(raw)))
            assert all(v in got for v in want), n
    assert values(gzip.compress(b"x y," + b"z" * 9000 + b'"password":"hunter2secret"')) == {'password":"hunter2secret'}


def deflated(raw):
    made = zlib.compressobj(wbits=-15)
    return made.compress(raw) + made.flush()


PACKERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "deflate": deflated}
UNPACKERS = {"gzip": gzip.decompress, "zlib": zlib.decompress, "bz2": bz2.decompress, "xz": lzma.decompress}
UNPACKERS["deflate"] = lambda raw: zlib.decompress(raw, -15)
ENCODERS = {
    "base64": lambda raw: base64.b64encode(raw).decode(),
    "urlsafe": lambda raw: base64.urlsafe_b64encode(raw).decode().rstrip("="),
    "percent": lambda raw: "".join(f"%{b:02x}" for b in raw),
    "quote": lambda raw: urllib.parse.quote(raw),
    "escape": lambda raw: "".join(f"\\x{b:02X}" for b in raw),
    "repr": lambda raw: repr(raw)[2:-1],
}


def brute_decode(text, way):
    """Undo layers by their names, innermost last."""
    for encoder, packer in way:
        raw = {
            "base64": base64.b64decode,
            "urlsafe": lambda t: base64.urlsafe_b64decode(t + "=" * (-len(t) % 4)),
            "percent": urllib.parse.unquote_to_bytes,
            "quote": urllib.parse.unquote_to_bytes,
            "escape": lambda t: bytes.fromhex(t.replace("\\x", "")),
            "repr": lambda t: t.encode().decode("unicode_escape").encode("latin-1"),
        }[encoder](text)
        text = (UNPACKERS[packer](raw) if packer else raw).decode()
    return text


def test_layers_against_a_brute_force_decoder():
    r, checked = random.Random(9), 0
    for n in range(400):
        inner = f"note {r.randrange(10**9)} {TOKEN} end"
        text, way = inner, []
        for _ in range(r.randrange(1, 4)):
            encoder = r.choice(list(ENCODERS))
            packer = r.choice([None, *PACKERS])
            if packer == "deflate" and encoder not in ("base64", "urlsafe"):
                packer = "gzip"  # without a header only where the run is all there is
            if packer is None and encoder in ("quote", "repr"):
                encoder = "percent"  # those leave plain text as it is
            raw = PACKERS[packer](text.encode()) if packer else text.encode()
            text, way = ENCODERS[encoder](raw), [(encoder, packer), *way]
        assert TOKEN in brute_decode(text, way)
        spans = [s for s in secrets.scan(f"see <{text}> there")[1] if s[3] == TOKEN]
        assert spans, way
        assert all(a >= 5 and b <= 5 + len(text) for a, b, *_ in spans), way
        checked += 1
    assert checked == 400


def test_every_value_of_a_run(spark):
    two = "first password=hunter22 then é� password=hunter33 end"
    run = base64.b64encode(two.encode()).decode()
    wrapped = "\n".join([run[:28], run[28:56], run[56:]])
    for text in (f"see {run} there", f"see {wrapped} there", f"see {urllib.parse.quote(run)} there"):
        spans = [s for s in secrets.scan(text)[1] if s[3] in ("password=hunter22", "password=hunter33")]
        assert [s[3] for s in spans] == ["password=hunter22", "password=hunter33"], text
        for a, b, _, value, _ in spans:
            assert value.encode() in base64.b64decode(urllib.parse.unquote(text[a:b])) and b - a < 40
    packed = base64.b64encode(gzip.compress(two.encode())).decode()
    rows = [(1, f"see {packed} there", "en", "a", 1)]
    got = secrets.scan_documents(frame(spark, rows)).collect()
    assert sorted(r.value for r in got) == ["password=hunter22", "password=hunter33"]
    assert {(r.start, r.end) for r in got} == {(4, 4 + len(packed))}
    assert secrets.scan_digests(frame(spark, rows)).first().spans == f"assign:4:{4 + len(packed)}"


def test_rows(spark):
    rows = [*hard(), (50, f"a {TOKEN} b {urllib.parse.quote('passwd=zzzzzzz')}", "en", "a", 1)]
    got = secrets.scan_digests(frame(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    one = next(r for r in got if r.doc_id == 50)
    assert (one.n_assign, one.n_access, one.n_hex) == (1, 0, 0)
    assert one.base_sha256 == hashlib.sha256(b"assign:2:20").hexdigest()
    assert one.spans == "assign:2:20,assign:23:39"
    assert all(r.spans == "" for r in got if r.doc_id != 50)
    assert secrets.scan_documents(frame(spark, rows)).count() == 2
    assert secrets.scan_digests(empty(spark)).count() == 0
