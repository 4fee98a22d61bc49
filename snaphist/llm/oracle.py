"""The corpus queries in SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d
), n AS (
  SELECT doc_id, len(s) AS n_shingles FROM g
), p AS (
  SELECT doc_id, unnest(s) AS x FROM g
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM p a JOIN p b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT i.a, i.b FROM i JOIN n x ON i.a = x.doc_id JOIN n y ON i.b = y.doc_id
  WHERE 100 * shared >= 90 * (x.n_shingles + y.n_shingles - shared)
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN l ON r.doc_id = l.a
)
SELECT n.doc_id, n_shingles, min(r.c) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY ALL
"""

OP4 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages
), q AS (
  SELECT page_id,
         translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM p
), r(verdict, h, pth) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), m AS (
  SELECT page_id, max_by(h || pth, length(h || pth)) AS rule, max_by(verdict, length(h || pth)) AS verdict
  FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pth)
  GROUP BY page_id
)
SELECT q.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM q LEFT JOIN m ON q.page_id = m.page_id
"""


OP6 = """
WITH e AS (
  SELECT vec_id, embedding AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(x, lambda c: floor(64 * c::DOUBLE)) AS x FROM e
), s AS (
  SELECT q.n AS qn, q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id) AS rk, vec_id, score FROM s
)
SELECT query_id, rk::INTEGER AS rank, vec_id, score FROM r WHERE rk <= 20
"""


OP8 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d
), v AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM s
), m AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) < doc_id AS bad FROM v
), g AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM m WHERE bad GROUP BY doc_id
), k AS (
  SELECT d.doc_id, len(w) AS n_words, list_filter(w, lambda x, i: NOT coalesce(list_contains(gone, i), false)) AS kept
  FROM d LEFT JOIN g ON d.doc_id = g.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, (n_words - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


_ROUND = """
), a{r} AS MATERIALIZED (
  SELECT n, vec_id, x, key % 16 AS c, key // 16 AS d FROM (
    SELECT v.n, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
           min((list_inner_product(v.x, k.x) * -2 + v.xx + k.xx)::HUGEINT * 16 + k.c) AS key
    FROM v CROSS JOIN k{r} k GROUP BY v.n)
"""

_MEANS = """
), m{r} AS (
  SELECT c, i, floor(sum(y) / count(*)) AS y
  FROM (SELECT c, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{p}) GROUP BY c, i
), l{r} AS (
  SELECT c, list(y ORDER BY i) AS x FROM m{r} GROUP BY c
), k{r} AS MATERIALIZED (
  SELECT c, x, list_inner_product(x, x) AS xx FROM (
    SELECT k.c, coalesce(l.x, k.x) AS x FROM k{p} k LEFT JOIN l{r} l ON k.c = l.c)
"""

OP11 = (
    """
WITH e AS (
  SELECT vec_id, embedding AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), f AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(x, lambda c: floor(64 * c::DOUBLE)) AS x FROM e
), v AS MATERIALIZED (
  SELECT n, vec_id, x, list_inner_product(x, x) AS xx FROM f
), k0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x, xx FROM v QUALIFY c < 16
"""
    + "".join(_ROUND.format(r=r - 1) + _MEANS.format(r=r, p=r - 1) for r in (1, 2, 3))
    + _ROUND.format(r=3)
    + """
)
SELECT vec_id, a3.c::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY a3.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(k3.x, lambda y: y::BIGINT), ',')) AS centroid_sha256
FROM a3 JOIN k3 ON a3.c = k3.c
"""
)

OP12 = rf"""
WITH s AS (
  SELECT true AS own, doc_id, {_LOWER} AS t FROM documents
  UNION ALL SELECT false, NULL, {_LOWER} FROM benchmark
), w AS MATERIALIZED (
  SELECT row_number() OVER () AS n, own, doc_id,
         list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM s
), c AS (
  SELECT n, own, unnest(w) AS x FROM w
), u AS (
  SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM c)
), b AS (
  SELECT x, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM u
), z AS (
  -- The table of the cyclic redundancy check: eight steps for each byte.
  SELECT list(list_reduce(range(8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384), v) ORDER BY v) AS z FROM range(256) g(v)
), h AS MATERIALIZED (
  SELECT x, xor(list_reduce(b, lambda r, y: xor(r >> 8, z[(xor(r, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS k
  FROM b, z
), g AS (
  SELECT k, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM c JOIN h USING (x) GROUP BY k
), a AS (
  SELECT sum(s)::BIGINT AS sn, sum(t)::BIGINT AS tn FROM g
), q AS (
  SELECT k, floor(1000 * ln(((t + 1) * (sn + 10000))::DOUBLE / ((s + 1) * (tn + 10000))::DOUBLE))::BIGINT AS gain FROM g, a
), p AS (
  SELECT n, count(*) AS m, floor(sum(gain) / count(*))::BIGINT AS weight FROM c JOIN h USING (x) JOIN q USING (k) WHERE own GROUP BY n
), d AS (
  SELECT doc_id, coalesce(m, 0) AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM w LEFT JOIN p USING (n) WHERE own
), e AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM e WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM e LEFT JOIN r USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": OP2, "op4_exact_dedup": OP4, "op5_url_rules": OP5, "op6_topk": OP6, "op8_substring_dedup": OP8,
        "op11_centroid_clusters": OP11, "op12_importance_resampling": OP12,
    }
