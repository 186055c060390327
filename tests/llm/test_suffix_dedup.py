import hashlib
import random
from collections import Counter

import numpy as np

from tripstream.llm import suffix_dedup as S

from tests.conftest import SF_SMALL


def plain(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[i : i + length] for _, x in data for i in range(len(x) - length + 1))
    out = []
    for d, x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abé ") for _ in range(rnd.randint(2, 9)))
    line = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(rnd.randint(5, 80)))) for i in range(40)]
    for i in range(40, 70):  # one line in many contexts, cut here and there
        a, b = sorted(rnd.sample(range(len(line)), 2))
        rows.append((i, " ".join(word() for _ in range(9)) + line[a:b] + " ".join(word() for _ in range(9))))
    rows += [(70, "ab" * 300), (71, "a" * 500), (72, None), (73, ""), (74, "\x00" * 90), (75, rows[3][1]), (75, rows[3][1]), (76, "z" + rows[3][1]), (None, rows[5][1]), (None, rows[6][1] + "x")]
    rows += [(77, "solo " + " ".join(word() for _ in range(20)))] + [(78, line + line[:90])]
    return rows


def got(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_bytes string")
    return sorted((tuple(r) for r in S.report(df, **options).collect()), key=str)


def test_against_brute_force(spark):
    rows = texts()
    want = plain(rows, 40)
    assert sum(w[2] > 0 for w in want) > 20
    assert got(spark, rows, length=40, gram=16) == want
    assert got(spark, rows, length=40, gram=16, most=1) == want  # every shared anchor dealt anew


def test_a_common_line_in_very_many_contexts(spark):
    rnd = random.Random(11)
    word = lambda n: "".join(rnd.choice("abcdefghijk") for _ in range(n))
    line = word(30)
    rows = [(i, word(rnd.randint(20, 60)) + line + (word(3) if i % 2 else line[:7]) + word(rnd.randint(20, 60))) for i in range(60)]
    want = plain(rows, 40)
    for most in (500, 8, 3):
        assert got(spark, rows, length=40, gram=16, most=most) == want


def test_given_table_at_the_contract_length(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted((tuple(r) for r in S.report(docs).collect()), key=str) == plain(rows, 200)


def test_two_stage_sorting_orders_suffixes():
    rnd = random.Random(1)
    for alphabet in (b"ab", b"a", bytes(range(1, 255)), b"abcd"):
        for _ in range(20):
            data = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 300)))
            want = sorted(range(len(data)), key=lambda i: data[i:])
            assert S.suffix_array(data, len(data)).tolist() == want
            depth = min(5, len(data))
            order = np.array([i for i in want if i + depth <= len(data)])
            lcp = S.common_prefixes(data, order, depth)
            for k in range(1, len(order)):
                a, b = data[order[k - 1] : order[k - 1] + depth], data[order[k] : order[k] + depth]
                assert lcp[k] == next((i for i in range(depth) if a[i] != b[i]), depth)


def test_segments_of_a_long_text_cross_buffers():
    rnd = random.Random(2)
    data = bytes(rnd.choice(b"abcdefgh") for _ in range(2 * S.BUFFER + 777))
    seen = 0
    for _, at, n, _, _, _ in S.segments([b"short", data], S.Grams()):
        seen += int(n.sum())
        assert (at + n + S.LENGTH - 1 <= len(data)).all()
    assert seen == len(data) - S.LENGTH + 1


def test_empty_table(spark):
    assert S.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_keys_are_joined_in_place(spark, monkeypatch):
    from tripstream.llm import common

    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    keys = rows.groupBy("k").count().where("count > 1 OR k % 2 = 0").withColumnRenamed("count", "n")
    want = sorted(map(tuple, rows.join(keys, ["k"]).collect()))
    for share in (1, 10, 1000, 10**9):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        assert sorted(map(tuple, common.joined_by_key(rows, keys, ["k"], "n", 3000).collect())) == want
