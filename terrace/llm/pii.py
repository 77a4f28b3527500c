"""Personal data: base patterns, and terms that reveal the entities found by co-occurring with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.text import let, lowered, running, stored, whole, words

KINDS = ("email", "ip", "card", "phone", "term")
#: Leftmost matches without retries. Quantifiers are possessive where nothing that follows could take
#: characters back, and a match starts at the start of its run or where the last one ended, since it
#: would start there anyway. So a long run of such characters is read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a kind to be looked for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
WORD = r"[^\x20\x09-\x0D]+"
MARKS = ".,;:!?()[]{}<>|*#$%&=\"'`"
SPANS = "array<struct<start:int,end:int,value:string>>"
FOUND = "array<struct<start:int,end:int,kind:int,value:string>>"
HIDDEN = "\uffff"  # stands for a base span where terms are told apart; a noncharacter
SUPPORT = 3  # different texts in which a term must stand with an entity
DISCLOSURE = 0.9  # share of an entity's information at which a term is taken to reveal it
PREFIX = 3  # letters that a term generalised to its first ones keeps
AREA = 4  # digits that a class of phone or card numbers has in common


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    return F.lit(True)


def luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string is right: from the right, every second digit is doubled."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def places(text: Column, pattern: str) -> Column:
    """The matches of a pattern in a text, as (start, end, value) in code points.

    Splitting at a pattern gives what lies between its matches, and with that
    the place of each one.
    """

    def placed(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            ends = running(F.transform(found, lambda x, i: F.length(F.get(gaps, i)) + F.length(x)))
            pairs = F.arrays_zip(ends.alias("end"), found.alias("value"))
            return F.transform(
                pairs,
                lambda p: F.struct(
                    (p["end"] - F.length(p["value"])).alias("start"), p["end"].alias("end"), p["value"].alias("value")
                ),
            )

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_gaps)).otherwise(F.array().cast(SPANS))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def matches(text: Column, kind: str) -> Column:
    """The valid matches of a kind in a text, as (start, end, kind, value)."""
    good = F.filter(places(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
    spans = F.transform(
        good,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), s["value"].alias("value")
        ),
    )
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(F.array().cast(FOUND))


def base_spans(text: Column) -> Column:
    """All valid matches in a text that is not null, by start, then kind."""
    return F.array_sort(F.concat(*[matches(text, kind) for kind in PATTERNS]))


def entity(span: Column) -> Column:
    """What a span names, however it is written."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    same = F.when(span["kind"] == 0, lowered(span["value"])).when(span["kind"] == 1, span["value"]).otherwise(digits)
    return F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), span["kind"]), same)


def named_by(span: Column) -> Column:
    """What a span names, and the classes that belongs to: its kind, and the mail domain, network or first phone digits."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    wider = (
        F.when(span["kind"] == 0, F.regexp_extract(lowered(span["value"]), "@.*", 0))
        .when(span["kind"] == 1, F.regexp_extract(span["value"], r"^[0-9]+\.[0-9]+\.", 0))
        .otherwise(digits.substr(1, AREA))
    )
    name = F.get(F.array(*map(F.lit, KINDS)), span["kind"])
    return F.array(entity(span), F.concat_ws("/", name, wider), name)


def shape(value: Column) -> Column:
    """A term by its kinds of characters: a run of letters is a ~, one of digits a 0; all else stands as it is."""
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "~"), "[0-9]+", "0")


#: To what a term is generalised, the narrowest first, and how that is written.
FAMILIES = {
    "prefix": (lambda t: F.when(F.length(t) > PREFIX, F.substring(t, 1, PREFIX)), lambda x: F.concat(x, F.lit("*"))),
    "shape": (shape, lambda x: x),
}


def term(word: Column) -> Column:
    return lowered(F.btrim(word, F.lit(MARKS)))


def text_terms(text: Column) -> Column:
    """The different terms of a text that is not null."""
    terms = F.array_distinct(F.transform(words(lowered(text)), lambda w: F.btrim(w, F.lit(MARKS))))
    return F.filter(terms, lambda t: t != "")


def own_terms(text: Column, spans: Column) -> Column:
    """The different terms of a text, without words that are part of a span."""

    def gap(s: Column, i: Column) -> Column:
        # a span that holds blanks has at most 19 digits, so few spans begin within it
        past = F.array_max(F.transform(F.slice(spans, F.greatest(i - 8, F.lit(0)) + 1, F.least(i, F.lit(8))), lambda o: o["end"]))
        begin = F.coalesce(past, F.lit(0))
        return text.substr(begin + 1, F.greatest(s["start"] - begin, F.lit(0)))

    last = F.array_max(F.transform(spans, lambda s: s["end"]))
    rest = text.substr(last + 1, F.length(text))
    clear = F.array_join(F.concat(F.transform(spans, gap), F.array(rest)), HIDDEN)
    kept = F.filter(words(lowered(clear)), lambda w: ~F.contains(w, F.lit(HIDDEN)))
    terms = F.array_distinct(F.transform(kept, lambda w: F.btrim(w, F.lit(MARKS))))
    return F.filter(terms, lambda t: t != "")


def occurrences(text: Column, shown: Column) -> Column:
    """All places in a text of the terms that are keys of the map ``shown``."""

    def trimmed(x: Column) -> Column:
        start = x["start"] + F.length(x["value"]) - F.length(F.ltrim(x["value"], F.lit(MARKS)))
        t = term(x["value"])
        return F.struct(
            start.alias("start"),
            (start + F.length(t)).alias("end"),
            F.lit(KINDS.index("term")).alias("kind"),
            t.alias("value"),
            F.try_element_at(shown, t).alias("shown"),
        )

    return F.filter(F.transform(places(text, WORD), trimmed), lambda x: x["shown"].isNotNull())


def joined(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(text, ",")


def digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def found(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row: columns to keep, a digest of the text, its base spans, and its terms if it has such spans."""
    text = F.col("__text")
    rows = docs.select(*keep, whole().alias("__text"))
    rows = rows.select(*keep, "__text", digest(text).alias("key"), base_spans(text).alias("spans"))
    none = F.array().cast("array<string>")
    own = F.when(F.size("spans") > 0, let(F.col("spans"), lambda s: own_terms(text, s))).otherwise(none)
    return rows.select(*keep, "key", "spans", own.alias("own"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """In how many rows of ``docs`` each term stands."""
    return docs.select(F.explode(text_terms(whole())).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosures(rows: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """Terms that reveal an entity, with what to put in their place.

    All probabilities are shares of documents. The information of an entity is
    IC(e) = -log2 p(e), and a term in the same document gives away PMI(t;e) =
    log2 p(t,e) / (p(t) p(e)) of that. From ``DISCLOSURE`` of it on the term is
    taken to reveal the entity, if it stood with it in ``SUPPORT`` different
    texts; copies of a text are one. Entities are single values and classes of
    them: a mail domain, a network, the first digits of a number, a kind. A
    term is generalised to its first letters if all terms with these reveal less
    than that, else to its shape if that does, and removed if not. As p(t,e) is
    at most p(e), a term can only reveal entities that are not much rarer, so
    that other pairs need not be formed.
    """
    n = F.lit(float(n_docs))
    texts = rows.where(F.size("spans") > 0).groupBy("key").agg(
        F.count("*").alias("copies"),
        F.first(F.array_distinct(F.flatten(F.transform("spans", named_by)))).alias("entities"),
        F.first("own").alias("own"),
    )
    texts = stored(texts, "texts")
    named = texts.select("key", "copies", F.explode("entities").alias("entity"))
    entities = named.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("n_texts"))
    entities = stored(entities.where(F.col("n_texts") >= SUPPORT).drop("n_texts"), "entities")
    most = n * F.pow(F.col("n_entity") / n, F.lit(DISCLOSURE)) * (1 + 1e-9)
    named = named.join(entities, "entity").withColumn("most", most)
    # only texts that name an entity so often, and only terms rare enough for one of it
    named = stored(named, "named")
    limits = stored(named.groupBy("key").agg(F.max("most").alias("limit")), "limits")
    own = texts.select("key", F.explode("own").alias("term")).join(limits, "key")
    rare = terms.where(F.col("n_term") >= SUPPORT)
    own = own.join(rare, "term").where(F.col("n_term") <= F.col("limit")).drop("limit")
    together = named.join(own, "key").where(F.col("n_term") <= F.col("most"))
    candidates = together.groupBy("entity", "term", "n_entity", "n_term").agg(
        F.sum("copies").alias("n_both"), F.count("*").alias("support")
    )

    def share(both: str, of: str) -> Column:
        pmi = F.log2(n * F.least(both, of) / (F.col(of) * F.col("n_entity")))
        return F.try_divide(pmi, F.log2(n / F.col("n_entity")))

    risky = candidates.where((F.col("support") >= SUPPORT) & (share("n_both", "n_term") >= DISCLOSURE))
    risky = stored(risky.select("entity", "n_entity", "term"), "risky")

    shown = F.lit("")
    for name, (family_of, written) in reversed(FAMILIES.items()):
        risky = stored(risky.withColumn(name, family_of(F.col("term"))), "risky")
        families = stored(risky.where(F.col(name).isNotNull()).select("entity", name).distinct(), "families")
        heads = texts.select("key", F.explode("own").alias("term")).groupBy("key", family_of(F.col("term")).alias(name))
        heads = heads.agg(F.count("*").alias("n_heads")).join(families.select(name).distinct(), name, "left_semi")
        both = named.join(families, "entity").join(heads, ["key", name]).groupBy("entity", "n_entity", name)
        both = both.agg(F.sum(F.col("copies") * F.col("n_heads")).alias("n_both_family"))
        masses = terms.groupBy(family_of(F.col("term")).alias(name)).agg(F.sum("n_term").alias("n_family"))
        general = both.join(masses, name).select("entity", name, (share("n_both_family", "n_family") < DISCLOSURE).alias(f"safe_{name}"))
        risky = risky.join(general, ["entity", name], "left")
        shown = F.when(F.col(f"safe_{name}"), written(F.col(name))).otherwise(shown)
    return risky.select("entity", "term", shown.alias("shown"))


def term_spans(docs: DataFrame, risky: DataFrame) -> DataFrame:
    """For each text (by digest) with terms that reveal an entity, wherever that stands, all places of them.

    What is removed for one entity is not shown in part for another, nor what is
    shown by its shape by its first letters.
    """
    rank = F.when(F.col("shown") == "", 0).when(F.col("shown").endswith("*"), 2).otherwise(1)
    risky = stored(risky.groupBy("term").agg(F.min_by("shown", F.struct(rank, "shown")).alias("shown")), "shown")
    texts = docs.select(whole().alias("text")).withColumn("key", digest(F.col("text")))
    hits = texts.select("key", F.explode(text_terms(F.col("text"))).alias("term")).join(risky, "term")
    hits = stored(hits.groupBy("key").agg(F.collect_set(F.struct("term", "shown")).alias("shown")), "hits")
    # a small table that keeps texts without such terms from being shuffled
    mark = F.xxhash64("key").alias("mark")
    marks = stored(hits.select(mark).distinct(), "marks")
    texts = texts.withColumn("mark", mark).join(marks, "mark", "left_semi")
    one = texts.groupBy("key").agg(F.first("text").alias("text"))  # copies of a text are looked at once
    return one.join(hits, "key").select("key", occurrences(F.col("text"), F.map_from_entries("shown")).alias("terms"))


def detect(docs: DataFrame, *keep: str) -> DataFrame:
    """Base spans and term spans of every row of ``docs``, beside columns to keep.

    Null texts count as empty; rows are never merged or dropped. The terms of
    equal texts are the same, so they are joined by the text's digest. Terms
    that are part of a base span have no span of their own.
    """
    rows = stored(found(docs, *keep), "found")
    terms = stored(vocabulary(docs), "terms")
    risky = stored(disclosures(rows, terms, max(1, rows.count())), "disclosures")
    near = stored(term_spans(docs, risky), "near")  # tables: Spark can split a hot key of the other side
    spans = rows.drop("own").join(near, "key", "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:int,value:string,shown:string>>")
    clear = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return spans.withColumn("terms", F.when(F.col("terms").isNull(), none).otherwise(clear))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and revealing terms generalised or removed.

    Of overlapping spans the first one counts. A null text stays null. Columns
    other than ``text`` stay as they are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    spans = detect(docs.select(row.alias("__row"), "text"), "__row")
    base = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.concat(F.lit("["), F.upper(F.get(F.array(*map(F.lit, KINDS)), s["kind"])), F.lit("]")).alias("shown"),
        ),
    )
    more = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["shown"].alias("shown")))
    text = F.col("__row.text")

    def step(state: Column, s: Column) -> Column:
        skip = s["start"] < state["at"]
        part = F.concat(text.substr(state["at"] + 1, s["start"] - state["at"]), s["shown"])
        return F.struct(
            F.when(skip, state["at"]).otherwise(s["end"]).alias("at"),
            F.when(skip, state["out"]).otherwise(F.concat(state["out"], part)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], text.substr(s["at"] + 1, F.length(text)))
    clean = F.aggregate(F.array_sort(F.concat(base, more)), start, step, rest)
    return spans.select(*[clean.alias("text") if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts and digest of the base spans, and all spans as text."""
    rows = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    bare = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base, more = F.transform("spans", bare), F.transform("terms", bare)

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(count, PATTERNS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat(base, more)).alias("spans"),
    )
