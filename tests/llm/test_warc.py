import hashlib
import io
import json
import re
import zlib

import pytest

from tripstream.llm import warc as W

BIG = "<p>" + "é" * 700 + "</p>"
ROWS = [
    (1, "http://a/", BIG, "x"), (2, "http://b/\r\nX: y", BIG, "x"), (3, None, BIG, "x"), (4, "u", "small", "x"), (5, "u", "small", "x"), (6, "u", None, "x"),
    (7, "u", "", "x"), (8, "u", "z" * 3_000_000, "x"), (8, "u", "z" * 3_000_000, "x"), (None, "u", "n" * 2000, "x"), (None, "u", "n" * 2000, "x"),
    (9, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 200, "x"), (None, "u", BIG, "x"),
]


def plain():
    out = []
    for i, _, h, _ in ROWS:
        p = (h or "").encode()
        same = [j for j, _, g, _ in ROWS if (g or "") == (h or "") and j is not None]
        m = max(same) if len(p) >= 1000 and same else None
        refers = m if m is not None and m != i else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def index(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, record_type string")
    return W.archive(df.repartition(2))


def test_round_trip(spark, index):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string, record_type string")
    assert sorted((tuple(r) for r in W.report(df.repartition(2)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == plain()
    assert sorted((tuple(r)[:4] for r in W.read(index).collect()), key=str) == sorted((r[:4] for r in plain()), key=str)


def test_records_are_valid_and_revisits_name_their_response(index):
    every = []
    for name in {r.archive for r in index.collect()}:
        fs, path = W._open(name)
        every += list(W.records(W.inflated(fs.open_input_stream(path, compression=None))))
    heads = [h for h, _ in every]
    for h in heads:  # the mandatory fields
        assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(h) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["warc-date"])
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", h["warc-record-id"])
    by_id = {h["warc-record-id"]: h for h in heads}
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert len(revisits) == sum(r[3] == "revisit" for r in plain())
    for h in revisits:
        to = by_id[h["warc-refers-to"]]
        assert to["warc-type"] == "response" and to["warc-payload-digest"] == h["warc-payload-digest"] and h["warc-profile"] == W.REVISIT
        assert h.get("warc-refers-to-target-uri") == to.get("warc-target-uri")
    assert sum(h["warc-type"] == "warcinfo" for h in heads) == len({r.archive for r in index.collect()})
    assert not any(k.startswith("x-refers") for h in heads for k in h)


def test_monoliths_are_gone(index):
    from pyarrow import fs as F

    fs, path = W._open(index.first().archive)
    folder = path.rpartition("/members/")[0]
    assert {x.base_name for x in fs.get_file_info(F.FileSelector(folder))} == {"members"}


def test_members_and_sidecar(index):
    rows = index.collect()
    for name in {r.archive for r in rows}:
        fs, path = W._open(name)
        whole = fs.open_input_file(path).read()
        side = [json.loads(x) for x in fs.open_input_file(path + ".cdxj").read().decode().splitlines()]
        own = sorted((r.offset, r.length, r.record_id) for r in rows if r.archive == name)
        assert [(x["offset"], x["length"], x["record_id"]) for x in side] == own
        at = 0
        for offset, length, _ in own:  # members follow each other without gaps
            assert offset == at and zlib.decompress(whole[offset : offset + length], 31).startswith(b"WARC/1.1\r\n")
            at += length
        assert at == len(whole)
        assert len(list(W.records(W.inflated(io.BytesIO(whole))))) == len(own)  # members one after another are a stream too


def test_truncated_stream_is_an_error():
    d = zlib.compressobj(1, wbits=31)
    whole = d.compress(W.record("response", 1, "u", b"x" * 5000)) + d.flush()
    with pytest.raises(EOFError):
        list(W.records(W.inflated(io.BytesIO(whole[:-20]))))


def test_empty_table(spark):
    assert W.report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
