import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripstream.llm import packing as P

TEXTS = [
    (1, "The quick  brown\nfox\tjumps, over 123 dogs'll"), (2, None), (3, ""), (4, "é́ Å  x 　 ﬁ İstanbul ΣΑΣ"),
    (5, "word " * 5000), (5, "word " * 5000), (None, "a<|endoftext|>b <|startoftext|>"), (6, "  lead\n\n trail \r\n"), (7, "don't I'm we'LL \x1c x\x85y"),
] + [(100 + i, "tie " * (i % 7)) for i in range(60)]


@pytest.fixture(scope="module")
def packed(spark):
    docs = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(TEXTS)], "doc_id long, text string, length string, offset int")
    return [r.asDict() for r in P.pack(docs, salts=4).collect()]


def expected(size=2048):
    tok = Tokenizer.from_file(P.vocabulary_path())
    out = Counter()
    for d, t in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            out[d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def test_pieces_equal_a_plain_tokenization(packed):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == expected()


def test_sequences_are_gapless_and_within_size(packed):
    own = {}
    for r in packed:
        own.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for slots in own.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in packed)
    assert len(own) == -(-total // 2048)  # as few as the tokens allow, here


def test_plan_against_best_fit_over_single_pieces():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 3000).tolist() + [100] * 50 + [7] * 900
    groups = P.plan(dict(Counter(lengths)), 100)
    got = Counter()
    for g in groups:
        assert sum(n * f for n, f, _ in g.slots) <= 100
        for n, f, _ in g.slots:
            got[n] += g.n * f
    assert got == Counter(lengths)
    free = []  # one by one
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        best = min(fits, default=100)
        if fits:
            free.remove(best)
        free.append(best - n)
    assert sum(g.n for g in groups) == len(free)


def test_ids_and_empty_table(spark):
    docs = spark.createDataFrame(TEXTS[:1], "doc_id long, text string")
    row = P.pieces(docs, with_ids=True).first()
    assert row.ids[-1] == 0 and len(row.ids) == row.length
    assert P.pack(docs.limit(0)).count() == 0


def test_full_pieces_are_sequences_of_their_own(spark, packed):
    full = [r for r in packed if r["length"] == 2048]
    assert len(full) >= 4 and all(r["offset"] == 0 for r in full)
    own = Counter(r["sequence_id"] for r in packed)
    assert all(own[r["sequence_id"]] == 1 for r in full)
