import hashlib
import zlib
from collections import Counter, defaultdict

from terrace.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    names = "depth at size k0 up0 band mark chars last length".split() if extra else []
    return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])


def mark(role: str, text: str) -> bytes:
    return hashlib.sha256("".join(f"{len(x.encode())}:{x}" for x in (role, text)).encode()).digest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, mark(role, text), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(lender, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        gain = (len(convs) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += gain
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(whole[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], sha))
    return Counter(out)


def check(spark, rows, extra=False):
    assert Counter(map(tuple, prefixes.prefix_trie(frame(spark, rows, extra)).collect())) == brute(rows)


def corpus():
    rows = []
    for c in [*range(-120, 330, 3), 1000, 1001]:
        for t in range(c % 9):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", f"t{t} " + "x" * (c % 2 if t < 3 else c % 5)))
    return rows


def test_agrees_with_brute_force(spark):
    check(spark, corpus(), extra=True)


def test_small_bands_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BAND", 2)
    monkeypatch.setattr(prefixes, "IDS", 3)
    check(spark, corpus())


def test_a_long_conversation_shares_its_beginning(spark):
    long = [(200, t, "user", f"turn {t % 7}") for t in range(900)]
    rows = long + [(c, t, "user", f"turn {t % 7}") for c in (201, 202, 203) for t in range(300 + c)]
    check(spark, rows)


def test_equal_conversations(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(600) for t in range(3)]
    check(spark, rows)


def test_hard_rows(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (1, 0, "user", ""),
        (1, 0, "user", ""),
        (1, 0, "a", "tie"),
        (1, 1, "", None),
        (2, None, None, None),
        (None, 3, "user", "of no conversation"),
        (100, 5, "user", "long " * 20_000),
        (100, 5, "user", "Ünïcode 😀 \x00"),
        (105, 0, "user", "one turn"),
        (-7, 0, "user", "below zero"),
        (-100, 0, "user", "lends"),
    ]
    check(spark, rows, extra=True)
    check(spark, [])
