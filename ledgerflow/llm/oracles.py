"""DuckDB SQL for the operators that SQL can express, over whole tables.

Token counts and ids, alignments, packing, toxicity, language-model scores and
bottom-k sketches are not SQL-expressible; tests/llm holds them against brute-force versions.
"""

from __future__ import annotations


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api")).replace(
    _either_case("api"), _either_case("api") + "_?" + _either_case("key"))
_ASSIGN = rf"""({_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_HITS = """
    list_transform(generate_series(1, len({w})), lambda i: {{
        'start': list_sum(list_transform({g}[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform({w}[1:i - 1], lambda x: length(x))), 0),
        'size': length({w}[i]), 'part': length({p}[i]), 'kind_no': {no}, 'kind': '{kind}', 'least': {least}}})"""

_OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, doc_id,
    regexp_extract_all(t, '{_ASSIGN}', 0) AS wa, regexp_extract_all(t, '{_ASSIGN}', 2) AS pa, string_split_regex(t, '{_ASSIGN}') AS ga,
    regexp_extract_all(t, 'AKIA[A-Z0-9]+') AS wk, string_split_regex(t, 'AKIA[A-Z0-9]+') AS gk,
    regexp_extract_all(t, '[0-9a-f]+') AS wh, string_split_regex(t, '[0-9a-f]+') AS gh
  FROM d),
h AS (
  SELECT r, doc_id, list_filter(list_concat(
    {_HITS.format(w="wa", g="ga", p="pa", no=0, kind="assign", least=8)},
    {_HITS.format(w="wk", g="gk", p="wk", no=1, kind="access", least=16)},
    {_HITS.format(w="wh", g="gh", p="wh", no=2, kind="hex", least=32)}), lambda s: s.part >= s.least) AS s
  FROM m),
o AS (SELECT r, doc_id, s, array_to_string(list_transform(list_sort(list_transform(s, lambda x: {{
    'start': x.start, 'kind_no': x.kind_no, 'size': x.size, 'kind': x.kind}})),
    lambda x: x.kind || ':' || x.start::BIGINT || ':' || (x.start + x.size)::BIGINT), ',') AS spans FROM h)
SELECT doc_id, len(list_filter(s, lambda x: x.kind = 'assign'))::BIGINT AS n_assign,
  len(list_filter(s, lambda x: x.kind = 'access'))::BIGINT AS n_access,
  len(list_filter(s, lambda x: x.kind = 'hex'))::BIGINT AS n_hex, sha256(spans) AS base_sha256, spans FROM o
"""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP4 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce('=' || source, 'null') AS key,
    len({_WORDS}) + 1 AS n_tokens, md5('mix' || coalesce(doc_id::VARCHAR, '')) AS hash FROM documents),
s AS (SELECT key, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY key),
x AS (SELECT max(ln(tokens / total)) - min(ln(tokens / total)) AS spread FROM s, (SELECT sum(tokens) AS total FROM s)),
b AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN exp(spread * (1 - (lo + hi) / 2)) <= 2.0 THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN exp(spread * (1 - (lo + hi) / 2)) <= 2.0 THEN (lo + hi) / 2 ELSE hi END
  FROM b, x WHERE i < 50),
a AS (SELECT CASE WHEN exp(spread) <= 2.0 THEN 0.0 ELSE round(hi, 9) END AS alpha FROM b, x WHERE i = 50),
w AS (SELECT key, tokens, round(exp(alpha * ln(tokens / total)) / sum(exp(alpha * ln(tokens / total))) OVER (), 12) AS weight
  FROM s, a, (SELECT sum(tokens) AS total FROM s)),
p AS (SELECT key, tokens::BIGINT AS tokens, greatest(round(weight * (SELECT max(tokens / weight) FROM w))::BIGINT, tokens::BIGINT) AS quota FROM w),
n AS (SELECT greatest(1, ceil((SELECT sum(n_tokens) FROM d) / 262144.0))::BIGINT AS blocks,
  greatest(1, ceil((SELECT sum(quota) FROM p) / 262144.0))::BIGINT AS out_blocks),
k AS (SELECT r, doc_id, source, key, n_tokens, hash, ('0x' || substr(hash, 1, 8))::BIGINT % blocks AS own FROM d, n),
z AS (SELECT key, own, sum(n_tokens) AS size FROM k GROUP BY key, own),
t AS (SELECT z.key, own, pass, size, tokens, quota, md5('mix|' || z.key || '|' || pass || '|' || own) AS shuffled
  FROM z JOIN p USING (key), unnest(generate_series(0, greatest(1, ceil(quota / tokens)::BIGINT) - 1)) AS u(pass)),
u AS (SELECT key, own, pass, quota, pass * tokens + coalesce(sum(size) OVER (PARTITION BY key, pass ORDER BY shuffled, own
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM t),
o AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY key, own ORDER BY hash, r
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM k),
f AS (SELECT doc_id, source, n_tokens, hash, pass, (start + inside)::BIGINT AS stream_start,
  floor((start + inside)::DOUBLE * out_blocks / quota)::BIGINT AS block FROM o JOIN u USING (key, own), n WHERE start + inside < quota)
SELECT doc_id, source, n_tokens, pass::INTEGER AS pass, stream_start, block,
  row_number() OVER (PARTITION BY block ORDER BY md5(hash || '|' || pass), stream_start)::INTEGER AS position FROM f
"""

_OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
v AS (SELECT r, doc_id, unnest(generate_series(1, len(w) - 49)) AS pos, w FROM d WHERE len(w) >= 50),
x AS (SELECT r, doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h FROM v),
y AS (SELECT r, pos FROM (SELECT r, doc_id, pos, min(doc_id) OVER (PARTITION BY h) AS first FROM x) WHERE doc_id > first),
c AS (SELECT DISTINCT r, pos + i AS pos FROM y, unnest(generate_series(0, 49)) AS u(i)),
g AS (SELECT r, list(pos) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(
    list_filter(generate_series(1, len(w)), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT r, unnest(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(
  generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM d WHERE len(w) > 0),
h AS (SELECT r, md5_number_lower(g) AS g FROM s),
n AS (SELECT r, count(*) AS n FROM h GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS both_ FROM h a JOIN h b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE both_ * 5 >= 4 * (x.n + y.n - both_)),
e AS (SELECT r AS a, r AS b FROM d UNION SELECT e.a, l.b FROM e JOIN l ON l.a = e.b),
k AS (SELECT e.a AS r, min(d.doc_id) AS class_id FROM e JOIN d ON d.r = e.b GROUP BY e.a)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM d JOIN k USING (r) LEFT JOIN (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a) USING (r)
"""

_OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT r, unnest(w) AS term FROM d),
f AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
g AS (SELECT (SELECT count(*) FROM d) AS n, (SELECT sum(len(w)) FROM d)::DOUBLE / (SELECT count(*) FROM d) AS average),
i AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM f, g GROUP BY term, n),
q AS (SELECT d.r, d.doc_id AS query_id, term, idf FROM d JOIN f USING (r) JOIN i USING (term) WHERE d.doc_id % 100 = 0),
z AS (SELECT q.r AS qr, query_id, d.doc_id, d.r,
    round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d.w) / average))), 6) AS score
  FROM q JOIN f USING (term) JOIN d ON d.r = f.r, g GROUP BY q.r, query_id, d.doc_id, d.r, average),
o AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, doc_id) AS rank FROM z)
SELECT query_id, doc_id, rank::INTEGER AS rank, score FROM o WHERE rank <= 10
"""

# Sums and products of integers below 2**53 are exact in DOUBLE.
_NEAREST = """
a{i} AS MATERIALIZED (SELECT r, arg_min(c, d) AS c, min(d) AS d FROM (
  SELECT r, c, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, m.x) + list_inner_product(m.x, m.x) + c / 1024.0 AS d
  FROM v CROSS JOIN c{i} m) GROUP BY r),"""
_MOVED = """
c{j} AS MATERIALIZED (SELECT c, coalesce(n.x, m.x) AS x FROM c{i} m LEFT JOIN (
  SELECT c, list(floor(s / n) ORDER BY pos) AS x FROM (
    SELECT c, pos, sum(x[pos]) AS s, count(*) AS n FROM v JOIN a{i} USING (r), unnest(generate_series(1, 64)) AS u(pos) GROUP BY c, pos)
  GROUP BY c) n USING (c)),"""
_OP13 = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (
  SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT 40)),
{"".join(_NEAREST.format(i=i) + _MOVED.format(i=i, j=i + 1) for i in range(5))}{_NEAREST.format(i=5)}
f AS (SELECT vec_id, a5.c, floor(a5.d)::BIGINT AS distance, m.x FROM v JOIN a5 USING (r) JOIN c5 m ON m.c = a5.c)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(x, lambda e: e::BIGINT::VARCHAR), ',')) AS centroid_sha256 FROM f
"""

ORACLE: dict[str, str] = {
    "op1_secret_ledger": _OP1,
    "op4_mixing": _OP4,
    "op5_substring_dedup": _OP5,
    "op6_ngram_jaccard": _OP6,
    "op7_bm25_wand": _OP7,
    "op13_bit_planes": _OP13,
}
