import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from terrace.llm import pii
from tests.llm.cases import LOWER, empty, frame, hard, words

BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == 0
                or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == 3 and 10 <= len(digits) <= 15
            )
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def agree(rows, got):
    assert len(got) == len(rows)
    texts = dict((r[0], r[1]) for r in rows)
    for r in got:
        spans = brute(texts[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), texts[r.doc_id][:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == q for _, k, _ in spans) for q in range(4)]
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == ([] if not text else text.split(","))


def test_base_spans_against_brute_force(spark):
    r = random.Random(3)
    alphabets = "aaab.@@%+_-  ..0123456789999((é😀\n", "0123456789.   -+", "+1 ()-.99"
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 70))) for a in alphabets for _ in range(700)]
    texts += [
        "4111 1111 1111 1111 and +1 (555) 123-4567, x@y.zz 1.2.3.255",
        "5500000000000004" * 2,
        "0255.1.1.1 256.1.1.1 00.00.000.0",
        "a@b.c_d@e.f g@h",
        "1.2.3.4.5.6.7.8",
    ]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    agree(rows, pii.digests(frame(spark, rows)).collect())


def test_long_runs_take_little_time_and_stack(spark):
    texts = ["a" * 60_000, "1" * 60_000, "1.1" * 20_000, "a@b." * 10_000 + "c", "+1" + "(" * 50_000, "x@" + "y." * 20_000 + "z"]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    agree(rows, pii.digests(frame(spark, rows)).collect())


def leaks(n=6):
    rows = [(i, f"word{i} filler{i * 7} call Marigold Zeta at mari.z@corp.com about x{i} thing{i}", "en", "a", 0) for i in range(n)]
    rows += [(100 + i, f"about call at marble stone {i} zeta{i}", "en", "a", 0) for i in range(80)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    rows = leaks()
    got = pii.digests(frame(spark, rows)).collect()
    agree(rows, got)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        terms = {text[int(a) : int(b)] for a, b in re.findall(r"term:(\d+):(\d+)", r.spans)}
        assert terms == ({"Marigold", "Zeta"} if r.doc_id < 100 else set())


def term_values(spark, rows):
    got = {r.doc_id: r.spans for r in pii.digests(frame(spark, rows)).collect()}
    text = {r[0]: r[1] for r in rows}
    return {i: [text[i][int(a) : int(b)] for a, b in re.findall(r"term:(\d+):(\d+)", s)] for i, s in got.items()}


def test_terms_go_wherever_they_stand(spark):
    far = " ".join(f"far{k}" for k in range(40))
    rows = [(i, f"Marigold own{i} {far} mari.z@corp.com then {far} (marigold) was{i}", "en", "a", 0) for i in range(4)]
    rows += [(50, "no address here but Marigold, twice Marigold", "en", "a", 0)]
    rows += [(100 + i, f"{far} then other text {i}", "en", "a", 0) for i in range(90)]
    got = term_values(spark, rows)
    assert all(got[i] == ["Marigold", "marigold"] for i in range(4))
    assert got[50] == ["Marigold", "Marigold"] and not any(got[100 + i] for i in range(90))


def test_the_same_signature_in_different_texts_reveals(spark):
    rows = [(i, f"letter{i} body{i}\nJane Doe, Sales, Acme <jane@acme.org> phone +1 555 123 4567", "en", "a", 0) for i in range(20)]
    rows += [(100 + i, f"sales and phone {i} for all", "en", "a", 0) for i in range(400)]
    got = term_values(spark, rows)
    assert all(got[i] == ["Jane", "Doe", "Acme"] for i in range(20)) and not any(got[100 + i] for i in range(400))


def test_copies_of_one_context_reveal_nothing(spark):
    rows = [(i, "call Marigold at mari.z@corp.com today", "en", "a", 0) for i in range(50)]
    rows += [(100 + i, f"other text {i}", "en", "a", 0) for i in range(50)]
    assert all("term" not in r.spans for r in pii.digests(frame(spark, rows)).collect())


def brute_disclosures(docs):
    """(entity, term) pairs that reveal, by the definition."""
    marks = pii.MARKS
    n, n_term, n_entity, both, support = len(docs), Counter(), Counter(), Counter(), defaultdict(set)
    for _, text, *_ in docs:
        low = text.translate(LOWER)
        spans = brute(text)
        names = set()
        for a, kind, b in spans:
            value, digits, kind_name = text[a:b], re.sub("[^0-9]", "", text[a:b]), pii.KINDS[kind]
            value = value.translate(LOWER) if kind == 0 else value if kind == 1 else digits
            wider = value[value.index("@") :] if kind == 0 else ".".join(value.split(".")[:2]) + "." if kind == 1 else digits[: pii.AREA]
            names |= {f"{kind_name}:{value}", f"{kind_name}/{wider}", kind_name}
        every = {w.strip(marks) for w in words(low)} - {""}
        own = {m[0].strip(marks) for m in re.finditer(r"[^\x20\x09-\x0D]+", low) if not any(m.start() < b and a < m.end() for a, _, b in spans)} - {""}
        n_term.update(every)
        n_entity.update(names)
        for e in names:
            for t in own:
                both[e, t] += 1
                support[e, t].add(text)
    out = set()
    for (e, t), k in both.items():
        if len(support[e, t]) >= pii.SUPPORT and n_entity[e] < n:
            pmi = math.log2(n * min(k, n_term[t]) / (n_term[t] * n_entity[e]))
            if pmi / math.log2(n / n_entity[e]) >= pii.DISCLOSURE:
                out.add((e, t))
    return out


def test_disclosures_against_brute_force(spark):
    r = random.Random(12)
    docs = []
    for i in range(500):
        text = " ".join(f"w{min(60, int(r.expovariate(0.08)))}" for _ in range(12)) + f" own{i}"
        if i % 4 == 0:
            who = r.randrange(6)
            text += f" Agent{who} of Dept{who % 2}, mail p{who}@firm{who % 2}.org, from 10.{who % 3}.0.{who}"
        if i % 9 == 0:
            text += f" dial +1 555 0{r.randrange(3)}0 {1000 + i} please"
        docs.append((i, text, "en", "a", 0))
    df = frame(spark, docs + docs[:20])
    rows = pii.found(df)
    got = {(x.entity, x.term) for x in pii.disclosures(rows, pii.vocabulary(df), len(docs) + 20).collect()}
    want = brute_disclosures(docs + docs[:20])
    assert got == want and {e.split(":")[0].split("/")[0] for e, _ in got} == {"email", "ip", "phone"}
    assert any("/@firm" in e for e, _ in got) and ("phone", "dial") in got


def test_classes_reveal_where_no_value_repeats(spark):
    docs = [(i, f"letter{i} write to Acme via u{i}@acme.org soon", "en", "a", 0) for i in range(12)]
    docs += [(100 + i, f"other letter{i} soon to write via {i}", "en", "a", 0) for i in range(300)]
    got = term_values(spark, docs)
    assert all(got[i] == ["Acme"] for i in range(12)) and not any(got[100 + i] for i in range(300))


def test_sanitised_text(spark):
    rows = [*leaks(), (900, None, "en", "a", 0), (901, "ip 1.2.3.4, card 4111-1111-1111-1111", "en", "a", 0)]
    df = frame(spark, rows, extra=True)
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    got = {r.doc_id: r.text for r in clean.collect()}
    # marble and zeta0 stand elsewhere, so the first letters of both reveal little
    assert got[0] == "word0 filler0 call mar* zet* at [EMAIL] about x0 thing0"
    assert got[901] == "ip [IP], card [CARD]" and got[900] is None and got[100] == "about call at marble stone 0 zeta0"


def test_hard_rows(spark):
    got = pii.digests(frame(spark, hard(), extra=True)).collect()
    assert len(got) == len(hard()) and all(r.spans == "" for r in got)
    assert pii.digests(empty(spark)).count() == 0
