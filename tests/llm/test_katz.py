import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripstream.llm import katz as L

from tests.conftest import SF_MID

SCHEMA = "doc_id long, text string, word string, n int"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</s>"]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


class Brute:
    def __init__(self, texts):
        self.uni, self.big = Counter(), Counter()
        for t in map(tokens, texts):
            self.uni.update(t)
            self.big.update(zip(["<s>", *t], t))
        self.n, self.after = sum(self.uni.values()), defaultdict(dict)
        for (y, z), c in self.big.items():
            self.after[y][z] = c
        self.du, self.db = (self.factors(x) for x in (self.uni, self.big))
        left = sum((1 - self.du.get(c, 1)) * c for c in self.uni.values())
        self.base = self.n if left > 0 else self.n + 1
        self.unk = (left if left > 0 else 1) / self.base

    @staticmethod
    def factors(counts):
        n = Counter(counts.values())
        for k in (5, 4, 3, 2):
            if all(n[r] for r in range(1, k + 2)) and (k + 1) * n[k + 1] < n[1]:
                a = (k + 1) * n[k + 1] / n[1]
                d = {r: ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, k + 1)}
                if all(0 < x < 1 for x in d.values()):
                    return d
        cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return {r: (r - cut) / r for r in range(1, 6)}

    def own(self, z):
        return self.du.get(self.uni[z], 1) * self.uni[z] / self.base if z in self.uni else self.unk

    def p(self, z, y):
        if y not in self.after:
            return self.own(z)
        seen = self.after[y]
        left, total = sum((1 - self.db.get(c, 1)) * c for c in seen.values()), sum(seen.values())
        if left <= 0:
            left, total = 1, total + 1
        if z in seen:
            return self.db.get(seen[z], 1) * seen[z] / total
        return left / total / (1 - sum(self.own(w) for w in seen)) * self.own(z)

    def rows(self, docs):
        for d, t in docs:
            ts = tokens(t)
            base = sum(math.log10((self.uni[z] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))) for z in ts)
            yield d, held(d), len(ts), sum(z in self.uni for z in ts), self.n, base, sum(math.log10(self.p(z, y)) for y, z in zip(["<s>", *ts], ts))


def check(spark, docs, **options):
    df = spark.createDataFrame([(*r, "w", 0) for r in docs], SCHEMA)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted(map(tuple, L.report(df, **options).collect()), key=key)
    want = sorted(Brute([t for d, t in docs if not held(d)]).rows(docs), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for column in (5, 6):
        np.testing.assert_allclose([r[column] for r in got], [r[column] for r in want], rtol=1e-9, atol=1e-9)
    return got


def made_up(seed, n, vocabulary):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, rng.choice([" ", "\t", " \n"]).join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40])))) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("vocabulary", [3, 400])
def test_as_brute_force(spark, parts, vocabulary, monkeypatch):
    docs = made_up(vocabulary, 300, vocabulary)
    docs += docs[:9] + [(None, "w1 w2 w1"), (7, None), (20, "É é ß never-seen"), (33, "w0 " * 3000)]
    monkeypatch.setattr(L, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(L, "SAMPLE", 1 if parts == 7 else 32)
    check(spark, docs, parts=parts)


def test_hot_word_and_contexts_without_discount(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE", 1)
    docs = [(i, "the " * 40 + f"end{i % 3}") for i in range(60)] + [(i, "a b") for i in range(60, 90)]
    check(spark, docs)


def test_nothing_to_learn_and_empty(spark):
    only = [d for d in range(200) if held(d)][:3]
    got = check(spark, [(d, "x y") for d in only] + [(None, None)])
    assert {r[6] for r in got} == {0.0} and {r[4] for r in got} == {0}
    assert L.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_probabilities_add_up_to_one_after_every_context():
    m = Brute([t for _, t in made_up(1, 200, 60)])
    for y in [*m.after, "unseen"]:
        assert sum(m.p(z, y) for z in m.uni) + m.p("unseen", y) == pytest.approx(1, abs=1e-12)


def test_discounts_are_good_turing_where_counts_allow():
    d = L.discounts([1000, 300, 150, 90, 60, 45])
    assert (np.diff(d[1:]) > 0).all() and 0 < d[1] < 1 and d[6] == 1
    assert L.discounts([0, 0, 0, 0, 0, 0])[1] == 0.5


def test_model_beats_the_base_on_held_out_text(spark):
    r = L.report(spark.read.parquet(f"{SF_MID}/documents.parquet")).where("held_out").selectExpr("sum(score) s", "sum(base_score) b", "count(*) n").first()
    assert r.n > 50 and r.s > r.b
