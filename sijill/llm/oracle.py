"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

import re

from .queries import URL_BLOCKED, URL_RULES

WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT"


def _glob_regex(glob: str) -> str:
    out = re.escape(glob).replace(r"\*\*", "(?:.|\\n)*").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return f"^{out}$"


def _op5() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    blocked = " OR ".join(f"regexp_matches(host || path, '{_glob_regex(g)}')" for g in URL_BLOCKED)
    return rf"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES {rules}),
ruled AS (
  SELECT page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS says
  FROM parts JOIN rules r ON (host = r.h OR suffix(host, '.' || r.h)) AND starts_with(path, r.p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN ruled USING (page_id)"""


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"):
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


OP8 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length({_escaped('text')}) + CASE role WHEN 'user' THEN length('<s>[INST]  [/INST]</s>') WHEN 'assistant' THEN length('<s></s>')
    ELSE length({_escaped('role')}) + length('<s>[ROLE][/ROLE]</s>') END AS chars FROM turns),
placed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM sized)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR back = 1), 0)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""

OP7 = r"""
WITH parts AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS tag,
         lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
         translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM pages),
p AS (
  SELECT page_id, url, tag, coalesce(scheme || '://' || CASE WHEN scheme = 'https' THEN regexp_replace(host, ':443$', '') ELSE regexp_replace(host, ':80$', '') END
    || CASE WHEN path = '' THEN '/' ELSE path END || query, '') AS key FROM parts),
r AS (SELECT page_id, key, tag, page_id::HUGEINT * 1000000000000 + 2 * page_id AS place FROM p),
v AS (
  SELECT page_id, key, url, CASE WHEN page_id % 7 = 3 THEN 'other' ELSE 'W/' || tag END AS tag,
         CASE WHEN page_id % 11 = 5 THEN page_id - 1 ELSE page_id + 2000 END AS ts FROM p),
j AS (
  SELECT v.*, r.page_id AS found, CASE WHEN r.page_id IS NULL THEN 'missing' WHEN regexp_replace(v.tag, '^W/', '') <> r.tag THEN 'mismatch' ELSE 'resolved' END AS outcome
  FROM v ASOF LEFT JOIN r ON v.key = r.key AND v.ts::HUGEINT * 1000000000000 + 2 * v.page_id + 1 > r.place)
SELECT 2 * page_id + 1 AS record_id, url, ts, coalesce(2 * found, -1) AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || tag || chr(10) || 'last-modified: day ' || (found % 365)
            ELSE 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || chr(10) || 'etag: ' || tag END AS headers
FROM j"""

OP10 = f"""
WITH sizes AS (
  SELECT doc_id, source, {WORDS} AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap FROM totals),
rated AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM weighted),
best AS (SELECT arg_min(rate, cap / weight) FILTER (rate * weight <= cap) AS rate FROM rated),
plan AS (
  SELECT source, source_size, least(cap, best.rate * weight) AS target,
         CASE WHEN source_size > 0 THEN floor(least(cap, best.rate * weight) / source_size)::BIGINT ELSE 0 END AS copies FROM rated, best),
groups AS (SELECT source, h, sum(size)::BIGINT AS s FROM sizes GROUP BY source, h),
placed AS (SELECT *, sum(s) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM groups)
SELECT d.doc_id, d.size, p.source_size, p.target,
       d.size * (p.copies + CASE WHEN g.upto <= b.budget OR (g.upto - g.s <= b.budget AND g.s < 2 * (b.budget - (g.upto - g.s))) THEN 1 ELSE 0 END) AS taken
FROM sizes d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN placed g ON g.source IS NOT DISTINCT FROM d.source AND g.h = d.h
CROSS JOIN LATERAL (SELECT p.target - p.copies * p.source_size AS budget) b"""




def _op12(rounds: int = 10) -> str:
    """Every round measures all distances. Products of doubles are exact here: components are far below 2^20."""
    measured = "(list_inner_product(p, p) - 2 * list_inner_product(p, q) + list_inner_product(q, q))::BIGINT"
    steps = [
        """p AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), vec_id, p)::INTEGER - 1 AS c, p AS q FROM p QUALIFY c < 8)",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': {measured}, 'c': c}}) AS best FROM p CROSS JOIN c{i} GROUP BY r)")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  WITH x AS (SELECT best.c AS c, unnest(range(64)) AS j, unnest(p)::BIGINT AS v FROM p JOIN a{i} USING (r)),
  s AS (SELECT c, j, sum(v)::BIGINT AS s, count(*) AS n FROM x GROUP BY c, j),
  m AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS q FROM s GROUP BY c)
  SELECT c, coalesce(m.q, o.q) AS q FROM c{i} o LEFT JOIN m USING (c))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(q, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM p JOIN a{rounds} USING (r) JOIN c{rounds} ON c = best.c"""


#: The checksum is made byte by byte from a table of 256 entries, which SQL makes from its rule. Words that differ by one code point show the same rest where it is left out.
OP13 = """
WITH bits AS (SELECT unnest(range(256)) AS b),
crc_table AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, b::BIGINT) ORDER BY b) AS t FROM bits),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS m FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
raw AS (SELECT w, m, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM low),
hashed AS (SELECT w, m, xor(4294967295::BIGINT, list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT)) AS h FROM raw, crc_table),
said AS (SELECT m, CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS w FROM hashed),
words AS MATERIALIZED (SELECT w, sum(m)::BIGINT AS n FROM said WHERE length(w) >= 7 GROUP BY w HAVING sum(m) >= 2),
cut AS MATERIALIZED (SELECT DISTINCT w, n, i, left(w, i) || substr(w, i + 2) AS rest FROM (SELECT w, n, unnest(range(length(w))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.w, a.n, b.w AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.w <> b.w
  UNION SELECT a.w, a.n, b.w, b.n FROM cut a JOIN words b ON a.rest = b.w
  UNION SELECT b.w, b.n, a.w, a.n FROM cut a JOIN words b ON a.rest = b.w),
best AS (SELECT w, count(*) AS n_near, min({'n': -near_n, 'w': near}) AS b FROM near GROUP BY w),
forms AS MATERIALIZED (SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 10 * n THEN b.w END AS form, CASE WHEN -b.n >= 10 * n THEN -b.n END AS form_n FROM words LEFT JOIN best USING (w)),
led AS (
  WITH RECURSIVE l AS (SELECT w, form AS root FROM forms WHERE form IS NOT NULL UNION ALL SELECT l.w, f.form FROM l JOIN forms f ON f.w = l.root WHERE f.form IS NOT NULL)
  SELECT l.w, l.root FROM l JOIN forms f ON f.w = l.root WHERE f.form IS NULL)
SELECT w AS word, form, coalesce(root, w) AS root, n, n_near, form_n FROM forms LEFT JOIN led USING (w)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filters": _op5(), "op7_warc_revisits": OP7, "op8_chat_prefix_targets": OP8, "op10_source_mixing": OP10, "op12_centroid_clustering": _op12(), "op13_spelling_variants": OP13}
