import zlib

from tripstream.llm import language as L
from tripstream.llm.queries import LLM_QUERIES

from tests.conftest import SF_MID

ROWS = [(i, t, x, "s") for i, (t, x) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 20)]
ODD = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 ½ !? ²", "de", "s"), (103, "the the", None, "s"), (None, "der garten", None, "s"),
       (104, "hausgarten", None, None), (105, "x" * 200_000, None, None), (104, "hausgarten", None, None)]
SCHEMA = "doc_id long, text string, lang string, score string"


def test_null_empty_letterless_and_backoff(spark):
    docs = spark.createDataFrame(ROWS + ODD, SCHEMA)
    got = {}
    for r in L.report(docs).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
        assert 0 <= r.score <= 1
    assert len(got[104]) == 2 and got[104][0] == got[104][1]
    assert [got[i][0][:2] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103][0][0] == "en" and got[None][0][0] == "de" and got[104][0][0] == "de" and got[105][0][0] in ("de", "en")
    for i, x in got.items():
        assert x[0][2] == (zlib.crc32(str(i).encode()) % 4 == 2 if i is not None else zlib.crc32(b"") % 4 == 2)


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "the", None, "s")], SCHEMA)
    assert [r.lang_pred for r in L.report(docs).collect()] == ["und"]
    assert L.report(docs.limit(0)).count() == 0


def test_backoff_goes_from_long_to_short():
    m = L.Model({"a": {"abcd": 5}, "b": {"wxyz": 5}})
    assert m.score("abcd")[0] > m.score("abcd")[1]  # known word
    assert m.score("xabcx")[0] > m.score("xabcx")[1]  # trigram
    assert m.score("zz")[1] > m.score("zz")[0]  # z>
    assert m.score("qq").tolist() == [0, 0]


def brute(docs):
    """Word-first backoff in plain Python: (doc_id, held out, language, score) of every document."""
    import math
    import re

    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    out_of = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2
    cut = lambda w, n: [(f"<{w}>" if n > 1 else w)[k: k + n] for k in range((len(w) + 2 if n > 1 else len(w)) - n + 1)]
    word, gram = {}, {n: {} for n in (4, 3, 2, 1)}
    learned = [(t, x) for i, t, x in docs if x is not None and t is not None and not out_of(i) and words(t)]
    langs = sorted({x for _, x in learned})
    for t, x in learned:
        for w in words(t):
            word.setdefault(w, dict.fromkeys(langs, 0))[x] += 1
            for n in gram:
                for g in cut(w, n):
                    gram[n].setdefault(g, dict.fromkeys(langs, 0))[x] += 1
    total = {id(table): {x: sum(c[x] for c in table.values()) for x in langs} for table in (word, *gram.values())}
    p = lambda table, key, x: math.log((table[key][x] + 0.5) / (total[id(table)][x] + 0.5 * len(table)))

    def score(w, x):
        if w in word:
            return p(word, w, x)
        for n in (4, 3, 2, 1):
            known = [g for g in cut(w, n) if g in gram[n]]
            if known:
                return sum(p(gram[n], g, x) for g in known) / len(known)
        return 0.0

    for i, t, _ in docs:
        if not langs or not any(c.isalpha() for w in words(t) for c in w):
            yield i, out_of(i), "und", 0.0
            continue
        s = {x: sum(score(w, x) for w in words(t)) for x in langs}
        best = min(langs, key=lambda x: (-s[x], x))
        yield i, out_of(i), best, 1 / sum(math.exp(min(s[x] - s[best], 0)) for x in langs)


def same(spark, rows):
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in L.report(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = sorted(brute([r[:3] for r in rows]), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))
    return got


def test_as_brute_force(spark):
    import random

    rng = random.Random(3)
    of = {"de": "der die das haus garten schön und", "en": "the house garden and of with", "fr": "la maison le jardin été et", "xx": "zz yy"}
    rows = [(i, " ".join(rng.choices(of[x].split() + ["mix", f"w{i % 9}"], k=rng.randrange(9))), x if i % 5 else None, "s") for i in range(200) for x in [rng.choice(sorted(of))]]
    rows += [(900 + i, " ".join("".join(rng.choices("abdehnrstuöé", k=5)) for _ in range(6)), None, "s") for i in range(40)] + ODD
    same(spark, rows)


def test_few_labelled_rows_are_learned_and_ties_go_to_the_smaller_code(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[0], "la maison verte", "fr", "s"), (ids[1], "the green house", "en", "s"), (ids[2], "a house", None, "s")]
    assert {r[0]: r[2] for r in same(spark, rows)} == {ids[0]: "fr", ids[1]: "en", ids[2]: "en"}
    tied = [(ids[0], "abc", "nl", "s"), (ids[1], "abc", "da", "s"), (ids[2], "abc", None, "s"), (ids[3], "ωψ", None, "s")]
    got = {r[0]: r[2:] for r in same(spark, tied)}
    assert got[ids[2]] == ("da", 0.5) and got[ids[3]] == ("da", 0.5)
    assert {r[2] for r in same(spark, [(ids[0], "only one", "sv", "s"), (ids[1], "??", "sv", "s"), (ids[2], "mehr", None, "s")])} == {"sv", "und"}


def test_held_out_accuracy_on_the_given_table(spark):
    out = LLM_QUERIES["op6_language"](spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    r = out.where("held_out").join(docs, "doc_id").selectExpr("avg(cast(lang_pred = lang as int)) a", "count(*) n").first()
    assert r.n > 200 and r.a > 0.97


def test_kept_returns_the_same_columns(spark):
    docs = spark.createDataFrame(ROWS + ODD, SCHEMA)
    kept = L.kept(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & {100, 101, 102} == set()
    assert kept.count() >= len(ROWS)
