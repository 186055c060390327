import re

from tripstream.llm import url_filter as U

ROWS = [
    (1, "HTTP://Sub.Example.NET/en/x?porn=1"), (2, "http://example.net/fr/"), (3, "http://example.net"), (4, "https://badexample.com/de/"),
    (5, "https://a.example.com/de/x"), (6, "http://x.org/fr/casino-poker"), (7, "http://x.org/en/casino-poker"), (8, "http://x.org/en/casino"),
    (9, "http://x.org/PORN"), (10, "http://x.org/pornography"), (11, None), (12, ""), (13, "no-scheme/xxx"), (14, "http://h?casino#poker"),
    (15, "http://h/casino/casino"), (16, "a://b://c/d"), (16, "a://b://c/d"), (None, "http://é.net/ü"), (17, "http://h/" + "é/" * 50_000 + "xxx"),
    (18, "http://a.net:80/x"), (19, "http://h/1sex9/bet"), (20, "http://h/\nsex?bet"),
]


def plain(url):
    m = re.match(r"(?s).*?://(.*)", url or "")
    rest = m.group(1) if m else ""
    raw = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(raw):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    hit = lambda ts: sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in ts)
    a, b = hit(U.STRICT), hit(U.SOFT)
    rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "block" if a or b > 1 else "allow")
    return host, path, rule, verdict, a, b


def test_against_plain_python(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in ROWS], "page_id long, url string, verdict string")
    got = [tuple(r)[1:] for r in U.judge(df).collect()]
    assert sorted(got, key=str) == sorted((plain(u) for _, u in ROWS), key=str)
    assert U.judge(df.limit(0)).count() == 0


def test_weights_are_a_parameter(spark):
    df = spark.createDataFrame([(1, "http://h/left-right"), (2, "http://h/left")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.n_strict, r.n_soft) for r in U.judge(df, weights={"left": 2, "right": 3}, limit=5, rules=()).collect()}
    assert got == {1: ("block", 0, 2), 2: ("allow", 0, 1)}
