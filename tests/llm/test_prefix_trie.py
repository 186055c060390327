import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tripstream.llm import prefix_trie as T
from tripstream.llm.oracle import LLM_ORACLE

from tests.conftest import SF_MID

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"
COLUMNS = T.COLUMNS


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            d = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            convs.setdefault(c, []).append(((t is not None, t or 0, r, d), (r, x)))
    own = {c: [p for _, p in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    nodes = {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        sub = [p for p in nodes if p[: len(path)] == path]
        kids = lambda p: sum(1 for q in nodes if len(q) == len(p) + 1 and q[:-1] == p)
        saved = sum((len(nodes[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p in sub)
        ends = ",".join(map(str, sorted(c for c in members if made[c] == path)))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), kids(path),
                    sum(kids(p) == 0 for p in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in T.report(df, **options).select(*COLUMNS).collect()), key=str)


def made_up(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            hot = rng.random() < 0.6
            rows.append((c, rng.choice([None, t, t]) if t < 2 else t, rng.choice(["user", None, "tool"]) if not hot else "user", f"hello there {t}" if hot else rng.choice([None, "", "a b  c", f"word {rng.random()}"])))
    return rows


@pytest.mark.parametrize("limit", [1, 12, 200_000])
def test_as_brute_force_at_every_shard_size(spark, limit):
    rows = made_up(limit, 60)
    assert got(spark, rows, shard_turns=limit) == brute(rows)


def test_copies_hot_first_turn_and_long_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(4)]
    rows += [(c, 0, "user", "same 0") for c in range(200, 240)] + [(c, 1, "user", f"own {c}") for c in range(200, 240)]
    rows += [(399, t, "user", f"t {t % 7}") for t in range(300)] + [(398, 0, "a", "x y")] * 3
    for limit in (7, 1000):
        assert got(spark, rows, shard_turns=limit) == brute(rows)


def test_nulls_turnless_and_empty(spark):
    rows = [(None, 0, "user", "no conversation"), (5, None, None, None), (5, 0, "user", "x"), (41, 0, "a", "only"), (20, 0, "a", "p"), (33, 0, None, "q")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(None, 1, "a", "b")]) == []
    assert T.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_double_array_holds_its_sequences():
    import numpy as np

    seqs = sorted({tuple(random.Random(i).choices(range(1, 9), k=random.Random(i).choice([0, 1, 2, 4, 7]))) for i in range(400)})
    sizes = np.array([len(s) for s in seqs])
    codes = np.array([c for s in seqs for c in s])
    base, check = T.packed(codes, np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    states = {}
    for s in seqs:
        at = 0
        for d, c in enumerate(s):
            assert check[base[at] + c] == at
            at = base[at] + c
            assert states.setdefault(at, s[: d + 1]) == s[: d + 1]
    assert len(states) == int((check >= 0).sum()) == len({s[: d + 1] for s in seqs for d in range(len(s))})


def test_given_table_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_MID}/conversations.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({LLM_ORACLE['op11_prefix_trie']})").fetchall()
    out = T.report(spark.read.parquet(f"{SF_MID}/conversations.parquet"), shard_turns=50).select(*COLUMNS).collect()
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
