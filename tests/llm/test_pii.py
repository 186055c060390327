import hashlib
import re

from tripstream.llm import pii as P

from tests.conftest import SF_SMALL

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain(text):
    out = []
    for i, (k, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if k == "ip" else True,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), i, m.end(), k))
    return sorted(out)


TEXTS = [
    None, "", "no data", "a@b.c_x@d.e.f tail@ @x.y a@b a@b.", "é😀 joe@mail.example.com, 🙂 10.0.0.1", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 000.0.0.00",
    "4111 1111-1111 1111 and 4111111111111112 and 0000000000000", "+1 (988) 555-2485 +49 30 12 +(1) 2345678901 +1234567890123456", "x" * 200_000,
    "." * 50_000 + "a@" + "b." * 50_000 + "c", "1" * 100_000, "1 2" * 3000, "+1" + "(" * 50_000, ("mail 1.2.3.4 or q@r.st " * 400), "5500005555555559 5500005555555559",
    "12.34.56.78@x.yz 4.4.4.4", "+" * 1000 + "1 23456789 0",
]


def test_base_spans_against_python(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")], "doc_id long, text string, spans string")
    rows = P.report(df).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        want = plain(TEXTS[r.doc_id])
        s = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r.base_sha256 == hashlib.sha256(s.encode()).hexdigest(), (r.doc_id, r.spans[:200], s[:200])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[3] == k for w in want) for k in PLAIN)


def test_base_spans_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = P.report(docs).collect()
    for r in rows:
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, _, b, k in plain(text[r.doc_id]))  # nothing is added to these texts
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0


def mixed(spark):
    rows = []
    for i in range(40):
        rows.append((f"contact joe{i}@mail.example.com, phone (212) 555-01{i:02d} or name Dr. Anna Smith",))
        rows.append((f"see section 200 300-4{i:03d} of release 300 400-5{i:03d}, page 000-00-0000",))
        rows.append((f"reach me: ann{i} (at) example (dot) org ssn 123-45-67{i:02d}",))
    return spark.createDataFrame(rows, "text string")


def test_votes_and_classifier_tell_loose_spans_apart(spark):
    docs = mixed(spark).selectExpr("monotonically_increasing_id() as doc_id", "text")
    rows = {r.text: r.spans for r in P.report(docs).join(docs, "doc_id").select("text", "spans").collect()}
    for text, spans in rows.items():
        kinds = {s.split(":")[0] for s in spans.split(",") if s}
        if text.startswith("contact"):
            assert {"email", "phone_local", "person"} <= kinds, (text, spans)
        elif text.startswith("see"):
            assert not kinds, (text, spans)
        else:
            assert {"email_spelled", "national_id"} <= kinds, (text, spans)


def test_redaction(spark):
    df = spark.createDataFrame([("é a@b.cd! 9.9.9.9@x.y 1", 1, None), (None, 2, 2**60 + 1), ("", 3, None), ("clean", 4, None)], "text string, _base long, n_ip long")
    got = {r["_base"]: (r.text, r.n_ip) for r in P.redacted(df).collect()}
    assert got == {1: ("é [EMAIL]! [EMAIL] 1", None), 2: (None, 2**60 + 1), 3: ("", None), 4: ("clean", None)}
    assert P.redacted(df).columns == df.columns


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.report(df).count() == 0
    plan = P.report(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_span_does_not_need_others_in_its_text_to_be_proposed(spark):
    df = spark.createDataFrame([("joe at example dotcom",), ("joe at example dot com",), ("joe (at) example.com",)], "text string")
    assert df.where(P.NEEDS["email_spelled"](df.text)).count() == df.where(df.text.rlike(P.PATTERNS["email_spelled"])).count() == 3
