import re
import hashlib

from tripstream.llm import decontaminate as D

SCHEMA = "doc_id long, text string, n_hit string"
W = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def brute(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, x in items:
            q = words(x)
            for a in range(max(1, len(q) - window + 1) if q else 0):
                p = q[a : a + window]
                for s in range(len(w) - len(p) + 1):
                    if w[s : s + len(p)] == p:
                        hit |= set(range(s, s + len(p)))
                        if i is not None:
                            ids.add(str(i))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, " ".join(W)), (2, "Éa short-item"), (10, " ".join(W[1:])), (None, "nameless words"), (4, ""), (5, None), (2, "again short")]
DOCS = [
    (1, "x " + " ".join(W).upper() + " y", "a"), (2, "x, Éa--SHORT item.", "b"), (3, None, "c"), (4, "", "d"),
    (5, " ".join(W[:9]), "e"), (6, " ".join(W[:10]) + " " + " ".join(W[2:]), None), (6, "nameless words again short", None),
    (6, "nameless words again short", None), (None, "again short", None), (7, "again Short " * 3000, "z"),
]


def test_against_brute_force_with_nulls_ties_and_clashing_columns(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    key = lambda r: tuple(map(str, r))
    want = sorted(brute([d[:2] for d in DOCS], ITEMS), key=key)
    assert sorted((tuple(r)[:6] for r in D.report(docs, items).collect()), key=key) == want
    # a benchmark too large for one block is answered in several, and shards of any size hold the same
    assert sorted((tuple(r)[:6] for r in D.report(docs, items, block_chars=40, shard_words=7).collect()), key=key) == want
    assert sorted(r.doc_id for r in D.clean(docs, items).collect()) == [3, 4, 5]
    assert D.clean(docs, items).columns == docs.columns


def test_proximity_and_spans(spark):
    docs = spark.createDataFrame([(1, "kappa one alpha two beta"), (2, "alpha beta kappa"), (3, "alpha " + "x " * 9 + "beta kappa")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta kappa")], "item_id long, text string")
    got = {r.doc_id: (list(r["_items"]), list(r["_near"]), list(r["_spans"])) for r in D.flagged(docs, items, slop=5).collect()}
    assert got == {1: ([], ["1"], []), 2: (["1"], [], [0, 2]), 3: ([], [], [])}


def near(docs, items, window=10, slop=15):
    """Per document: ids of items with some window whose every word is within ``slop`` consecutive words, but no exact match."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    for d, t in docs:
        w, out = words(t), set()
        exact = {i for i, x in items for q in [words(x)] for a in range(max(1, len(q) - window + 1) if q else 0)
                 if any(w[s: s + len(q[a: a + window])] == q[a: a + window] for s in range(len(w)))}
        for i, x in items:
            q = words(x)
            for a in range(max(1, len(q) - window + 1) if q else 0):
                if i is not None and i not in exact and any(set(q[a: a + window]) <= set(w[s: s + slop]) for s in range(len(w))):
                    out.add(i)
        yield d, len(out)


def test_stored_index_and_proximity_against_brute_force(spark):
    import random

    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(14)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 12])))) for i in range(12)] + [(None, "w1 w2"), (50, "absent words")]
    docs = [(i, " ".join(rng.choices(vocabulary + ["zz"], k=rng.choice([0, 3, 20, 60])))) for i in range(80)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted((*b, n) for b, (_, n) in zip(brute(docs, items), near(docs, items)))
    assert sum(r[-1] for r in want) > 20
    for limit in (1, 50, 10_000):
        index = D.build(df, shard_words=limit)
        got = D.search(index, bench).selectExpr("doc_id", "_n_words", "_n_hit", "size(_items) AS n", "size(_near) AS k").collect()
        assert sorted((r.doc_id, r._n_words, r._n_hit, r.n, r.k) for r in got) == [(r[0], r[1], r[2], r[3], r[6]) for r in want]
    assert sorted(map(tuple, D.report(df, bench).collect())) == want
    # the stored index answers another benchmark
    assert D.search(index, bench.where("item_id = 50")).where("_n_hit > 0").count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.report(docs, none).where("contaminated").count() == 0
    assert D.report(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_one_block_of_the_benchmark_at_a_time(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y z"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(("a b", "b c", "x y", "y z"))], "item_id string, text string")
    got = D.flagged(docs, items, window=2, block_chars=5)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: list(r["_items"]) for r in got.collect()} == {1: ["0", "1"], 2: ["2", "3"], 3: []}
