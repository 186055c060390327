import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tripstream.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output as rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34", None, None, 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(2))
    out = []
    for name, stage in P.STAGES:
        done = P.staged(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((name, docs, done))
        docs = done
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(stages):
    assert [n for n, _, _ in stages] == ["language", "near_copies", "decontaminate", "personal_data", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == COLUMNS and after.dtypes == before.dtypes


def test_language_rejects_what_has_no_letters_and_keeps_clean_documents(stages):
    _, before, after = stages[0]
    gone = Counter(rows(before)) - Counter(rows(after))
    assert {d for d, _ in gone} >= {9001, 9002, 9003}
    assert len(list(gone.elements())) <= 5


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    own = rows(before)
    root = plain_components([plain_fingerprint(t) for _, t in own], lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (d, _), r in zip(own, root):
        least[r] = min(d, least.get(r, d))
    assert sorted(d for d, _ in rows(after)) == sorted(least.values())


def test_leaks_go(stages, spark):
    _, before, after = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute(rows(before), items) if not r[-1]}
    assert {d for d, _ in rows(after)} == clean


def test_personal_data_is_redacted(stages):
    _, before, after = stages[3]
    got = dict(rows(after))
    for d, t in rows(before):
        want, at = "", 0
        for a, _, b, k in plain_spans(t):
            want, at = want + t[at:a] + f"[{k.upper()}]", b
        assert got[d] == want + t[at:]
    assert all(r.n_chars == len(r.text) for r in after.collect())
    assert not any(re.search(r"@mail[0-9]\.example", t) for t in got.values())


def test_packing_covers_the_rest(stages):
    _, before, after = stages[4]
    tok = Tokenizer.from_file(packing.vocabulary_path())
    want = Counter()
    for d, t in rows(before):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[d, k, at, zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in after.collect()) == want


def test_run_equals_the_stages(stages, spark):
    run = P.run(spark, SF_SMALL)
    assert run.columns == stages[-1][2].columns and run.count() > 0


def test_empty_tables_and_further_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    for name, d, b in (("none", docs.limit(0), bench), ("free", docs, bench.limit(0))):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        b.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
    assert P.run(spark, f"{tmp_path}/free").count() >= P.run(spark, SF_SMALL).count()
    own = ["component_id", "_score", "_lang", "_n_hit", "_base", "_k0", "fingerprint"]
    more = docs.selectExpr("*", *[f"'x' AS {c}" for c in own])
    for name, stage in P.STAGES[:-1]:
        more = P.staged(stage(spark, more, SF_SMALL), f"more-{name}")
        assert more.columns == [*COLUMNS, *own]
