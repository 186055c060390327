"""URL verdicts: host and path rules first, then a weighted vocabulary.

Rules are (host, path, verdict): a rule fits its host and all subdomains when the url's
path starts with the rule's; the longest fitting rule decides. A url without a rule is
searched, lower-cased, for every term of the vocabulary in one pass of an Aho-Corasick
automaton. A hit counts only between boundaries (no letter or digit on either side), a
term counts once however often it occurs, and the url is rejected when the weights of its
distinct terms reach ``LIMIT``: one strict term, or several soft ones.

Defined cases: a null or empty url, or one without ``://``, has empty host and path and no
rule, and is allowed unless its text reaches the limit (null: allowed); repeated rows and
ids are judged row by row; very long urls are searched whole; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import ascii_lower

#: (host, path, verdict); written host + path in results
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

STRICT = ("porn", "xxx", "hentai", "camsex", "escorts", "warez", "phishing", "malware")
SOFT = ("adult", "bet", "bingo", "casino", "crack", "dating", "jackpot", "keygen", "loans", "nude", "poker", "sex", "slots", "torrent", "viagra", "webcam")
LIMIT = 2
WEIGHTS = {**{t: LIMIT for t in STRICT}, **{t: 1 for t in SOFT}}


def _edge(text: str, at: int) -> bool:
    """No ASCII letter or digit at ``at`` (outside the text counts as an edge)."""
    return not (0 <= at < len(text) and (("a" <= text[at] <= "z") or ("0" <= text[at] <= "9")))


def term_counter(weights: dict[str, int] = WEIGHTS, limit: int = LIMIT):
    """Pandas UDF: url -> number of distinct strict (weight at the limit) and soft terms, and their weight."""
    weights = dict(weights)

    @F.pandas_udf("n_strict int, n_soft int, weight int")
    def count(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        for part in urls:
            rows = []
            for url in part:
                hits = set()
                if isinstance(url, str) and weights:
                    hits = {t for end, t in automaton.iter(url) if _edge(url, end + 1) and _edge(url, end - len(t))}
                own = [weights[t] for t in hits]
                strict = sum(w >= limit for w in own)
                rows.append((strict, len(own) - strict, sum(own)))
            yield pd.DataFrame(rows, columns=["n_strict", "n_soft", "weight"])

    return count


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule (host + path) and verdict of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", rules=RULES, weights=None, limit: int = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), n_strict, n_soft."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    host, path = parts(F.col("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_v": verdict, "_t": term_counter(WEIGHTS if weights is None else weights, limit)(ascii_lower(F.col("_url")))})
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce("_v", F.when(F.col("_t.weight") >= limit, "block").otherwise("allow")).alias("verdict"),
                       F.col("_t.n_strict").alias("n_strict"), F.col("_t.n_soft").alias("n_soft"))
