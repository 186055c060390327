import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tripstream.llm import ranked_search as R
from tripstream.llm.oracle import LLM_ORACLE

from tests.conftest import SF_MID

DOCS, ITEMS = "doc_id long, text string, item_id int, score string", "item_id long, text string, rank int"
_CUT = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return _CUT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in asked.items():
        scored = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "s") for r in docs], DOCS)
    q = spark.createDataFrame([(*r, 1) for r in items], ITEMS)
    index = R.build(d, shard_points=options.pop("shard_points", R.SHARD_POINTS))
    return sorted((tuple(r) for r in R.search(index, q, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def made_up(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ß", "x9", "THE", "the"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(rng.randrange(10 * n), rng.choice([" ", "-", "\n"]).join(rng.choices(vocabulary, weight, k=rng.choice([0, 1, 3, 20, 200])))) for _ in range(n)]
    return docs + docs[:7] + [(None, "w1 w2"), (5, None), (6, " .. ")], [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 4, 30])))) for i in range(15)]


@pytest.mark.parametrize("points", [1, 150, 1 << 18])
def test_as_brute_force_at_every_shard_size(spark, points):
    docs, items = made_up(points, 160)
    assert got(spark, docs, items, shard_points=points) == brute(docs, items)


def test_blocks_of_items_and_other_k(spark):
    docs, items = made_up(3, 90)
    assert got(spark, docs, items, block_pairs=20, k=3, shard_points=200) == brute(docs, items, 3)


def test_copies_tie_by_doc_id(spark):
    docs = [(i, "a common passage") for i in range(300, 0, -1)] + [(1000, "a b"), (1001, "zz")]
    items = [(1, "common passage"), (2, "nothing here"), (3, None), (None, "zz")]
    out = got(spark, docs, items, shard_points=40)
    assert out == brute(docs, items) and [r[2] for r in out if r[0] == 1 and r[1] <= 3] == [1, 2, 3]


def test_items_with_one_id_and_empty_tables(spark):
    docs, _ = made_up(9, 40)
    items = [(1, "w1 w2"), (1, "w3 w2"), (1, "w1 w2"), (2, "x" * 100_000 + " w5")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, [], items) == [] and got(spark, docs, []) == []


def test_cells_hold_the_largest_impact():
    rng = np.random.default_rng(5)
    rows, cols = np.divmod(rng.choice(64 * 32, 500, replace=False), 32)
    impacts = rng.integers(1, 1000, 500)
    raw = R.Treap.build(rows, cols, impacts, 6)
    tree = R.Treap(6, *raw)
    for cell in range(tree.points, len(tree.level)):
        level = int(tree.level[cell])
        inside = (rows >> level == tree.row[cell] >> level) & (cols >> level == tree.col[cell] >> level)
        assert tree.peak[cell] == impacts[inside].max() and (tree.kids[cell - tree.points] >= 0).sum() > 1


def test_most_of_a_shard_is_not_visited():
    rng = np.random.default_rng(1)
    n = 4096
    rows, cols = np.concatenate([np.zeros(n, int), np.ones(12, int)]), np.concatenate([np.arange(n), rng.choice(n, 12, replace=False)])
    raw = R.Treap.build(rows, cols, rng.integers(500, 600, len(rows)), 12)
    tree = R.Treap(12, *raw)
    met, least, best = 0, np.zeros(1, np.int64), []
    for _, c, s in R.best_first(tree, np.zeros(2, np.int64), np.array([0, 1]), np.array([10, 1000]), least):
        met += len(c)
        best = sorted(best + s.tolist(), reverse=True)[:10]
        least[0] = best[-1] if len(best) == 10 else 0
    assert met < 100


def test_given_tables_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({LLM_ORACLE['op12_k2_treap_search']})").fetchall()
    read = lambda t: spark.read.parquet(f"{SF_MID}/{t}.parquet")
    out = R.report(read("documents"), read("benchmark"), shard_points=5000).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, out)) == sorted(want) and len(want) == 400
