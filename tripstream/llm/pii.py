"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans: four base kinds (email, ip, card, phone), whose valid matches are
always reported, and looser kinds that need a judgement. Five labelers vote on every
proposal (personal, not personal, or abstain): a strict format, a gazetteer, cue words
before it, counter-cues before it, and company in the same text. Expectation-maximisation
over the counts of vote patterns (at most kinds x 3^5 rows, whatever the corpus) estimates
each labeler's reliability and each kind's prior without labels. The posteriors then train
the final classifier, naive Bayes over the kind, the shape of the span, the words beside it and the
votes (hashed to ``FEATURES`` slots), which decides on the looser proposals. A looser span that
overlaps a base span is dropped.

Matches and their places come from one pass of split and one of regexp_extract_all over the
same pattern: the text between matches and the matches, whose lengths add up to offsets in
code points. Patterns are anchored and possessive where that changes no match, so that no
text makes them backtrack. Votes, counts and training cover every document.

Defined cases: a null or empty text has no spans; repeated rows are judged row by row (and
counted row by row in training); with no proposals at all the classifier is neutral and
accepts nothing; an empty table gives no rows; extra columns are ignored, or carried by
``redacted``. Overlapping spans of different kinds are all reported and redacted as one.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import carried, staged

BASE = ("email", "ip", "card", "phone")
LOOSE = ("email_spelled", "phone_local", "national_id", "person")
KINDS = BASE + LOOSE

FIRST_NAMES = ("James", "John", "Robert", "Michael", "David", "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Anna", "Maria", "Peter",
               "Paul", "Thomas", "Hans", "Klaus", "Jean", "Pierre", "Marie", "Sophie", "Carlos", "Juan", "Luis", "Carmen", "Emma", "Laura")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Sra", "Srta", "Don")
DOMAINS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "eu", "io", "info")
CUES = ("e-?mail", "mail", "contact", "phone", "tel", "mobile", "call", "fax", "address", "card", "visa", "ssn", "name", "ip", "host", "server", "write to", "reach")
COUNTER_CUES = ("version", "release", "isbn", "issn", "page", "chapter", "figure", "table", "section", "order", "serial", "model", "build", "doi")

_NAME = f"(?:{'|'.join(FIRST_NAMES)})"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:[(\[{]at[)\]}] ?[A-Za-z0-9-]++ ?(?:\.|[(\[{]dot[)\]}])|at [A-Za-z0-9-]++ dot) ?[A-Za-z]{2,10}(?![A-Za-z0-9])",
    "phone_local": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": rf"(?<![A-Za-z])(?:(?:{'|'.join(TITLES)})\.? [A-Z][a-z]{{1,20}}|{_NAME})(?: [A-Z][a-z]{{1,20}})?(?![A-Za-z])",
}
#: what a text must hold for a pattern to be worth running
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][ -]?[0-9]"),
    "phone": lambda t: t.contains("+"),
    "email_spelled": lambda t: t.rlike(r"[(\[{]at[)\]}]|at [A-Za-z0-9-]++ dot"),
    "phone_local": lambda t: t.rlike(r"[0-9]{3}[ .-][0-9]{4}"),
    "national_id": lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
    "person": lambda t: t.rlike(rf"(?<![A-Za-z])(?:(?:{'|'.join(TITLES)})\.? [A-Z]|{_NAME}(?![A-Za-z]))"),
}
LABELERS = ("format", "gazetteer", "cue", "counter", "company")
VOTES = (1, 0, -1)
ROUNDS = 6
ACCEPT = 0.8
SHAPES, WORDS = 512, 1024
VOTE_SLOTS = len(KINDS) + SHAPES + 2 * WORDS
FEATURES = VOTE_SLOTS + 3 * len(LABELERS)
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a lambda variable is a value, not an expression)."""
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _places(parts: Column) -> Column:
    """From (text before, match) pairs: the matches with start, end and neighbouring text.

    Running lengths are summed in blocks of ``BLOCK``, so many matches stay linear.
    """
    none = F.array().cast("array<struct<s:int,e:int,m:string,b:string,a:string>>")

    def located(z: Column) -> Column:
        lengths = F.transform(z, lambda x: F.length(x.p) + F.coalesce(F.length(x.m), F.lit(0)))

        def offsets(n: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int")),
                                 lambda b: _total(F.slice(n, b * BLOCK + 1, F.lit(BLOCK))))
            before = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

            def at(i: Column, p: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                return p[block] + _total(F.slice(n, block * BLOCK + 1, i - block * BLOCK))

            return let(before, lambda p: F.transform(F.slice(z, 1, F.size(z) - 1), lambda x, i: let(
                at(i, p) + F.length(x.p), lambda s: F.struct(
                    s.alias("s"), (s + F.length(x.m)).alias("e"), x.m.alias("m"),
                    F.substring(x.p, -40, 40).alias("b"), F.substring(z[i + 1].p, 1, 40).alias("a")))))

        return F.when(F.size(z) > 1, let(lengths, offsets)).otherwise(none)

    return let(parts, located)


def raw(text: Column, kind: str) -> Column:
    """All matches of a kind's pattern: array of (s, e, m, b, a); leftmost, not overlapping."""
    pattern = PATTERNS[kind]
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    return F.when(NEEDS[kind](text), _places(parts)).otherwise(F.array().cast("array<struct<s:int,e:int,m:string,b:string,a:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + weighed(i)) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]|[0-9]|(?<=0))(?:\.|$)){4}$")
    if kind == "card":
        return let(_digits(m), lambda d: F.length(d).between(12, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, x: Column, base_spans: Column) -> Column:
    """One vote per labeler: 1 personal, 0 not, -1 abstains."""
    m, vote = x.m, lambda c, yes, no: F.when(c, yes).otherwise(no)
    digits = _digits(m)
    strict = {
        "email": m.rlike(r"\.[A-Za-z]{2,10}$"), "ip": valid("ip", m), "card": valid("card", m), "phone": valid("phone", m),
        "email_spelled": m.rlike(r"[(\[{]at[)\]}]"), "phone_local": m.rlike(r"^\([0-9]{3}\)|^[0-9]{3}([ .-])[0-9]{3}\1"),
        "national_id": ~m.rlike("^(?:000|666|9)|-00-|-0000$"), "person": m.rlike("^[A-Z][a-z]+\\.? [A-Z][a-z]+"),
    }[kind]
    listed = {
        "email": m.rlike(rf"(?i)\.(?:{'|'.join(DOMAINS)})$"), "ip": ~m.rlike(r"^(?:0|127|255)\."), "card": digits.rlike("^[3-6]"),
        "phone": digits.rlike("^[1-9]"), "email_spelled": m.rlike(rf"(?i)(?:{'|'.join(DOMAINS)})$"), "phone_local": digits.rlike("^[2-9]"),
        "national_id": digits.rlike("^[0-7]"), "person": m.rlike(rf"(?:^| ){_NAME}(?: |$)"),
    }[kind]
    before = F.lower(x.b)
    return F.array(vote(strict, 1, 0), vote(listed, 1, 0), vote(before.rlike(rf"(?:^|[^a-z])(?:{'|'.join(CUES)})[^a-z]"), 1, -1),
                   vote(before.rlike(rf"(?:^|[^a-z])(?:{'|'.join(COUNTER_CUES)})[^a-z]"), 0, -1),
                   vote(F.exists(base_spans, lambda y: (y.s != x.s) & (F.abs(y.s - x.s) < 200)), 1, -1))


def _features(kind: str, x: Column, votes: Column) -> Column:
    """Slots of the classifier: kind, shape, word before, word after, and each labeler's vote."""
    slot = lambda c, n, at: (F.pmod(F.crc32(c.cast("binary")), F.lit(n)) + at).cast("int")
    shape = F.substring(F.regexp_replace(F.regexp_replace(x.m, "[0-9]", "9"), "[A-Za-z]+", "a"), 1, 24)
    at = len(KINDS)
    cast = F.transform(votes, lambda v, i: VOTE_SLOTS + 3 * i + v + 1)
    return F.concat(cast, F.array(F.lit(KINDS.index(kind)), slot(shape, SHAPES, at),
                   slot(F.regexp_extract(F.lower(x.b), r"(\S+)\s*$", 1), WORDS, at + SHAPES),
                   slot(F.regexp_extract(F.lower(x.a), r"^\s*(\S+)", 1), WORDS, at + SHAPES + WORDS)))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(x.s.alias("s"), F.lit(KINDS.index(kind)).alias("k"), x.e.alias("e")))


def _proposed(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` with ``_raw_<kind>`` (all matches) and ``_base`` (valid base spans)."""
    frame = frame.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    frame = frame.withColumns({f"_raw_{k}": raw(F.col("_text"), k) for k in KINDS})

    def sound(kind: str) -> Column:
        return _spans(kind, F.filter(F.col(f"_raw_{kind}"), lambda x: valid(kind, x.m)))

    base = [sound(k) for k in BASE]
    return frame.withColumn("_base", F.array_sort(F.concat(*base)))


def fit(docs: DataFrame, *, text: str = "text", rounds: int = ROUNDS) -> list[float]:
    """Weights of the final classifier, one per slot; at most ``FEATURES`` numbers."""
    return _fitted(_proposed(docs.select(F.col(text).alias("_t")), "_t"), rounds)


def _fitted(rows: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """``fit`` on matches that are listed already (``_proposed``)."""
    def proposals(kind: str) -> Column:
        return F.transform(F.col(f"_raw_{kind}"), lambda x: let(_votes(kind, x, F.col("_base")), lambda v: F.struct(
            F.lit(KINDS.index(kind)).alias("k"), v.alias("v"), _features(kind, x, v).alias("f"))))

    every = F.concat(*[proposals(k) for k in KINDS])
    seen = staged(rows.select(F.explode(every).alias("x")).select("x.*"), "pii-proposals")
    patterns = seen.groupBy("k", "v").agg(F.count("*").alias("n")).collect()  # bounded: kinds x 3^labelers
    if not patterns:
        return [0.0] * FEATURES
    given = json.dumps([{"k": r["k"], "v": list(r["v"]), "n": r["n"]} for r in patterns])
    votes = rows.sparkSession.range(0, 1, 1, 1).select(F.explode(F.from_json(F.lit(given), "array<struct<k:int,v:array<int>,n:bigint>>")).alias("x")).select("x.*")
    prior = [0.5] * len(KINDS)
    rates = [({1: 0.6, 0: 0.1, -1: 0.3}, {1: 0.2, 0: 0.45, -1: 0.35})] * len(LABELERS)  # P(vote | personal), P(vote | not)
    for _ in range(rounds):
        weighed = votes.withColumn("p", _posterior(prior, rates))
        of = lambda w, i, v: F.sum(F.when(F.col("v")[i] == v, F.col("n") * w).otherwise(0.0))
        sums = [of(w, i, v) for i in range(len(LABELERS)) for w in (F.col("p"), 1 - F.col("p")) for v in VOTES]
        per_kind = weighed.groupBy("k").agg(F.sum(F.col("n") * F.col("p")), F.sum("n"), *sums).collect()
        for r in per_kind:
            prior[r[0]] = (r[1] + 1) / (r[2] + 2)
        total = [sum(r[3 + j] for r in per_kind) for j in range(len(sums))]
        # an imagined vote of each sort keeps a labeler from becoming certain
        share = lambda x: {v: (n + 1) / (sum(x) + len(VOTES)) for v, n in zip(VOTES, x)}
        rates = [(share(total[6 * i : 6 * i + 3]), share(total[6 * i + 3 : 6 * i + 6])) for i in range(len(LABELERS))]
    trained = seen.withColumn("p", _posterior(prior, rates)).select("p", F.explode("f").alias("f"))
    slots = trained.groupBy("f").agg(F.sum("p").alias("a"), F.sum(1 - F.col("p")).alias("b"))
    logs = slots.select("f", (F.log(F.col("a") + 0.5) - F.log(F.col("b") + 0.5)).alias("w"), "a", "b").collect()  # bounded: FEATURES
    yes, no = sum(r["a"] for r in logs if r["f"] < len(KINDS)), sum(r["b"] for r in logs if r["f"] < len(KINDS))
    out = [0.0] * FEATURES
    base_rate = _log_ratio(yes, no)
    for r in logs:
        # a kind's slot is its own log odds; the other slots add what they say beyond the base rate
        out[r["f"]] = r["w"] - (0.0 if r["f"] < len(KINDS) else base_rate)
    return out


def _log_ratio(a: float, b: float) -> float:
    return math.log(a + 0.5) - math.log(b + 0.5)


def _posterior(prior: list[float], rates: list[tuple[dict[int, float], dict[int, float]]]) -> Column:
    """Probability that a proposal (columns k, v) is personal data.

    Base kinds are anchors: their rule is the definition, so their format vote is the truth
    (every email match is valid); the labelers' reliabilities carry over to the looser kinds.
    """
    odds = F.element_at(F.array(*[F.lit(math.log(x / (1 - x))) for x in prior]), F.col("k") + 1)
    for i, (yes, no) in enumerate(rates):
        vote = F.col("v")[i]
        odds = odds + F.when(vote == 1, math.log(yes[1] / no[1])).when(vote == 0, math.log(yes[0] / no[0])).otherwise(math.log(yes[-1] / no[-1]))
    return F.when(F.col("k") == 0, 1.0).when(F.col("k") < len(BASE), F.col("v")[0].cast("double")).otherwise(1 / (1 + F.exp(-odds)))


def _spotted(rows: DataFrame, columns: list[str], weights: list[float], accept: float) -> DataFrame:
    """``columns`` of ``rows`` (``_proposed``) with ``_base`` and ``_all``: sorted arrays of (s, k, e)."""
    w = F.from_json(F.lit("[" + ",".join(repr(float(x)) for x in weights) + "]"), "array<double>")

    def judged(kind: str) -> Column:
        def sure(x: Column) -> Column:
            odds = F.aggregate(_features(kind, x, _votes(kind, x, F.col("_base"))), F.lit(0.0), lambda a, f: a + F.element_at(w, f + 1))
            free = ~F.exists(F.col("_base"), lambda y: (y.s < x.e) & (x.s < y.e))
            return (1 / (1 + F.exp(-odds)) >= accept) & free

        return _spans(kind, F.filter(F.col(f"_raw_{kind}"), sure))

    rows = rows.withColumn("_all", F.array_sort(F.concat("_base", *[judged(k) for k in LOOSE])))
    return rows.select(*columns, "_base", "_all")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x.k + 1), x.s.cast("string"), x.e.cast("string"))), ",")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans (all, as kind:start:end)."""
    rows = _proposed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    # the patterns run over each text once: what they match is small, and is read for the fit and the verdict
    rows = staged(rows.select("doc_id", *[f"_raw_{k}" for k in KINDS], "_base"), "pii-matches")
    found = _spotted(rows, ["doc_id"], _fitted(rows), accept)
    count = lambda i: F.size(F.filter("_base", lambda x: x.k == i)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_all")).alias("spans"))


def redacted(docs: DataFrame, *, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; other columns as they are."""
    frame, inner, names = carried(docs)
    key = inner[names.index(text)]
    rows = _spotted(_proposed(frame, key), frame.columns, fit(frame, text=key), accept)
    # spans that overlap become one, named after the first
    merged = F.aggregate("_all", F.array().cast("array<struct<s:int,k:int,e:int>>"), lambda a, x: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1).e > x.s),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1).s.alias("s"), F.element_at(a, -1).k.alias("k"), F.greatest(F.element_at(a, -1).e, x.e).alias("e")))),
    ).otherwise(F.concat(a, F.array(x))))
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    t = F.col(key)

    def rebuilt(m: Column) -> Column:
        parts = F.transform(m, lambda x, i: let(F.when(i > 0, m[i - 1].e).otherwise(0), lambda p: F.concat(
            F.substr(t, p + 1, x.s - p), F.element_at(labels, x.k + 1))))
        return F.concat(F.array_join(parts, ""), F.substr(t, F.element_at(m, -1).e + 1))

    fresh = F.when(F.size("_all") > 0, let(merged, rebuilt)).otherwise(t)
    return rows.withColumn(key, fresh).select(*inner).toDF(*names)
