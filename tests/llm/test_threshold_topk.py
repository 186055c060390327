import math

import numpy as np

from tripstream.llm import threshold_topk as T

SCHEMA = "vec_id long, embedding array<float>, score int"


def plain(rows, every, k):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i is not None and i % every == 0}):
        own = [v for i, v in ok if i == q]
        s = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for v in own for i, w in ok if i != q]
        out += [(q, r + 1, None if n else i, -x) for r, (x, n, i) in enumerate(sorted(s)[:k])]
    return out


def rows(n, width, spread, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)) * spread).astype(np.float32)
    return [(i, v.tolist(), 0) for i, v in enumerate(x)]


def test_against_brute_force_with_ties_nulls_and_clashing_columns(spark):
    data = rows(300, 6, 1.0, 1) + [(400, None, 0), (420, [1.0, None], 0), (440, [float("nan")], 0), (460, [float("inf"), 0.0], 0),
                                   (480, [], 0), (500, [1.0, -2.0], 0), (None, [3.0, 3.0], 0), (501, [0.5] * 6, 0), (501, [0.5] * 6, 0)]
    df = spark.createDataFrame(data, SCHEMA)
    want = plain(data, 20, 7)
    for options in ({}, {"shard_rows": 40, "block_queries": 5}):
        got = sorted(tuple(r) for r in T.report(df, k=7, **options).collect())
        assert got == want
    assert T.report(df.limit(0)).count() == 0
    few = spark.createDataFrame(data[:3], SCHEMA)
    assert sorted(tuple(r) for r in T.report(few).collect()) == plain(data[:3], 20, 20)


def test_stops_early_where_the_bound_allows():
    rng = np.random.default_rng(4)
    x = rng.integers(-20, 21, (5000, 4))
    x[:30] *= 50  # a few rows far ahead
    lists = T.Lists(np.arange(5000), x, np.float32)
    early = 0
    for q in rng.integers(-9, 10, (40, 4)):
        found = lists.search(None, q, 5)
        s = x @ q
        best = T._best(s, np.arange(5000), 5)
        if found is not None:
            early += 1
            assert found[0].tolist() == best.tolist()
    assert early > 10


def test_large_components_stay_exact():
    x = np.array([[2_000_000_000, 1], [2_000_000_000, 2]])
    assert [s for _, _, s in T._search(np.array([1, 2]), x, np.array([9]), x[:1], 2)] == [4 * 10**18 + 2, 4 * 10**18 + 1]


def test_reads_on_until_the_bound_closes_or_all_rows_are_met():
    rng = np.random.default_rng(8)
    x = rng.integers(-60, 61, (700, 64))  # dense: the bound closes late or never
    lists = T.Lists(np.arange(700), x, np.float32)
    for q in [*rng.integers(-60, 61, (10, 64)), np.zeros(64, np.int64)]:
        places, scores = lists.search(3, q, 5)
        others = np.delete(np.arange(700), 3)
        best = others[T._best((x @ q)[others], others, 5)]
        assert places.tolist() == best.tolist() and scores.tolist() == (x @ q)[best].tolist()


def test_a_score_reached_elsewhere_stops_a_query_earlier_and_loses_nothing():
    rng = np.random.default_rng(12)
    x = rng.integers(-20, 21, (3000, 6))
    lists = T.Lists(np.arange(3000), x, np.float32)
    for q in rng.integers(-9, 10, (30, 6)):
        s = x @ q
        for least in (int(np.sort(s)[-3]), int(s.max()), int(s.max()) + 1):
            places, scores = lists.search(None, q, 5, least)
            best = T._best(s, np.arange(3000), 5)
            assert [p for p in best.tolist() if s[p] >= least] == [p for p, v in zip(places.tolist(), scores.tolist()) if v >= least]


def test_vectors_stay_where_they_are(spark):
    df = spark.createDataFrame(rows(200, 4, 1.0, 2), SCHEMA)
    out = T.report(df, shard_rows=30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "query_id" in plan and plan.count("Exchange") == 1  # only the results are dealt, by query
