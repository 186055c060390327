"""DuckDB SQL of the queries that SQL can state, written from the contracts."""

from __future__ import annotations

from tripstream.llm import url_filter

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
hit AS (SELECT DISTINCT g.doc_id, g.i, g.n, win.item_id
        FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
              FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)) g JOIN win ON win.s = g.s AND win.n = g.n),
per AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
-- proximity: the distinct words of a window within 15 consecutive words of a document
wt AS (SELECT DISTINCT w.item_id, w.s, x FROM win w, unnest(string_split(w.s, ' ')) AS u(x)),
wn AS (SELECT item_id, s, count(*) AS k FROM wt GROUP BY item_id, s),
dp AS (SELECT doc_id, r, i, w[i] AS x FROM (SELECT row_number() OVER () AS r, doc_id, w FROM d), unnest(range(1, len(w) + 1)) AS u(i)),
cand AS (SELECT r, item_id, s, k FROM (SELECT DISTINCT r, x FROM dp) JOIN wt USING (x) JOIN wn USING (item_id, s) GROUP BY r, item_id, s, k HAVING count(*) = k),
span AS (SELECT doc_id, dp.r, cand.item_id, cand.s, cand.k, list(dp.x) OVER (PARTITION BY dp.r, cand.item_id, cand.s ORDER BY i RANGE BETWEEN 14 PRECEDING AND CURRENT ROW) AS xs
         FROM cand JOIN dp USING (r) JOIN wt ON wt.item_id IS NOT DISTINCT FROM cand.item_id AND wt.s = cand.s AND wt.x = dp.x),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM span WHERE len(list_distinct(xs)) = k
           AND NOT EXISTS (SELECT 1 FROM hit WHERE hit.doc_id IS NOT DISTINCT FROM span.doc_id AND hit.item_id = span.item_id) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN near USING (doc_id)
"""

_LOWER = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _terms(terms) -> str:
    return " + ".join(f"CAST(regexp_matches(lowered, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t in terms)


def _rules() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)


OP2 = f"""
WITH u AS (SELECT page_id, {_LOWER} AS lowered, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, lowered, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rh, rp, rv) AS (VALUES {_rules()}),
best AS (SELECT p.*, (SELECT arg_max(struct_pack(rule := rh || rp, verdict := rv), length(rh || rp)) FROM r
                      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS won FROM p),
c AS (SELECT *, CAST({_terms(url_filter.STRICT)} AS INTEGER) AS n_strict, CAST({_terms(url_filter.SOFT)} AS INTEGER) AS n_soft FROM best)
SELECT page_id, host, path, won.rule AS rule, n_strict, n_soft,
       coalesce(won.verdict, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM c
"""

OP7 = """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS digest FROM p),
m AS (SELECT digest, max(page_id) AS m, count(*) AS c FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN m.m IS NOT NULL AND m.m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.m <> page_id THEN m.m END AS refers_to
FROM d LEFT JOIN m ON m.digest = d.digest AND c > 1
"""

OP11 = """
WITH bits AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS v
              FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
tu AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS p,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
       FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(p ORDER BY k) AS s FROM tu GROUP BY conv_id),
hs AS (SELECT conv_id, s, conv_id - conv_id % 20 AS root,
              xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(ch) AS BIGINT) for ch in string_split(CAST(conv_id AS VARCHAR), '')]),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
       FROM own, bits),
made AS (SELECT a.conv_id, list_concat(coalesce(o.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM hs a LEFT JOIN own o ON o.conv_id = a.root),
pre AS (SELECT conv_id, d, s[1:d] AS q, len(s) = d AS ends FROM made, unnest(range(0, len(s) + 1)) AS r(d)),
node AS (SELECT q, min(conv_id) AS conv_id, d AS depth, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS e
         FROM pre GROUP BY q, d),
kids AS (SELECT q[1:depth - 1] AS q, count(*) AS c FROM node WHERE depth > 0 GROUP BY 1),
val AS (SELECT node.*, coalesce(c, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(q[depth].x, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS v
        FROM node LEFT JOIN kids USING (q)),
up AS (SELECT q[1:a] AS q, sum(v) AS saved, sum(CAST(n_children = 0 AS BIGINT)) AS leaves FROM val, unnest(range(0, depth + 1)) AS r(a) GROUP BY 1)
SELECT val.conv_id, val.depth, par.conv_id AS parent_conv_id, val.n_convs, val.n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(val.e) AS ends_sha256
FROM val JOIN up USING (q) LEFT JOIN node par ON par.q = val.q[1:val.depth - 1] AND val.depth > 0
"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
tot AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
p AS (SELECT r, x, count(*) AS tf FROM d, unnest(t) AS u(x) GROUP BY r, x),
w AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, tot GROUP BY x, nn),
q AS (SELECT DISTINCT item_id, x FROM (SELECT item_id, {_TERMS} AS t FROM benchmark), unnest(t) AS u(x)),
s AS (SELECT item_id, d.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
      FROM q JOIN w USING (x) JOIN p USING (x) JOIN d USING (r), tot GROUP BY item_id, r, d.doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""

LLM_ORACLE = {
    "op2_url_filter": OP2,
    "op7_threshold_topk": OP7,
    "op9_decontaminate": OP9,
    "op10_warc": OP10,
    "op11_prefix_trie": OP11,
    "op12_k2_treap_search": OP12,
}
