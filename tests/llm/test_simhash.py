import random
import re

import numpy as np
import xxhash

from tripstream.llm import components as C
from tripstream.llm import simhash as S


def plain_fingerprint(text, n=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    s = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(nodes, near):
    root = list(range(len(nodes)))
    for i in range(len(nodes)):
        for j in range(i):
            if near(nodes[i], nodes[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def texts():
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefgh") + rnd.choice("xyz") for _ in range(60)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        w = rnd.choice(base).split()
        w[rnd.randrange(len(w))] = "changed"
        rows.append((100 + i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "One"), (504, "one"), (505, "ÀB two"), (505, "ÀB two"), (None, "one"), (506, "w " * 70000), (505, base[0])]
    return rows


def test_fingerprints_and_components_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, fingerprint string")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.fingerprint, r.component_id) for r in S.report(docs).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    assert got == sorted(((d if d is not None else -1), f"{f:016x}", least.get(r)) for (d, _), f, r in zip(rows, fps, root))
    kept = S.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_links_in_cells_of_any_size_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = set(rng.integers(0, 2**63, 200, dtype=np.uint64).tolist())
    for _ in range(500):  # a dense ball: many fingerprints in one bucket
        f = int(rng.choice(centres))
        for b in rng.choice(64, rng.integers(1, 9), replace=False):
            f ^= 1 << int(b)
        fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "_fp long")
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    for cell in (1024, 16):
        edges = [(r.a % 2**64, r.b % 2**64) for r in S.links(df, cell=cell).collect()]
        assert all((a ^ b).bit_count() <= 64 for a, b in edges)
        joined = set(edges) | {(b, a) for a, b in edges}
        got = plain_components(fps, lambda a, b: (a, b) in joined)
        assert got == want


def test_pivot_bound_never_discards_a_linked_pair():
    p = S.references()
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ np.uint64(0b10010000001)
    d = np.abs(np.bitwise_count(a[:, None] ^ p).astype(int) - np.bitwise_count(b[:, None] ^ p))
    assert d.max() <= 3 and len(set(p.tolist())) == S.PIVOTS


def test_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 70), (80, None), (45, 44), (43, 45)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {**{i: 1 for i in range(2, 41)}, 60: 50, 45: 43, 44: 43}
    for at_once in (500_000, 5):  # one task, and rounds of stars
        assert {r.node: r.root for r in C.stars(df, at_once=at_once).collect()} == want
    assert C.stars(df.limit(0)).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.report(docs).count() == 0 and S.survivors(docs).count() == 0
