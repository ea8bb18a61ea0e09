"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 4], ' ') END AS gram
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 5 * k >= 4 * (p.n + q.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(lowest.b, d.doc_id)) AS class_id,
       coalesce(degree.n, 0)::BIGINT AS n_links
FROM d LEFT JOIN lowest ON lowest.a = d.doc_id LEFT JOIN degree ON degree.a = d.doc_id
"""

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5('mix:17:' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
capped AS (  -- sources by how soon they reach their cap
  SELECT source, n, w, sum(n) OVER () AS total,
         coalesce(sum(2 * n) OVER before, 0) AS caps_before,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left,
         row_number() OVER (ORDER BY n / w, source NULLS LAST) AS k
  FROM s
  WINDOW before AS (ORDER BY n / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (  -- the first source whose share stays within its cap, if any
  SELECT k, 3 * total - 2 * caps_before AS goal, w_left
  FROM capped WHERE (3 * total - 2 * caps_before) * w <= 2 * w_left * 2 * n
  ORDER BY k LIMIT 1),
t AS (
  SELECT source, n, CASE WHEN level.k IS NULL OR c.k < level.k THEN (2 * n)::DOUBLE
       ELSE (w * goal)::DOUBLE / (2 * level.w_left)::DOUBLE END AS target
  FROM capped c LEFT JOIN level ON true),
p AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                              ROWS UNBOUNDED PRECEDING) - size AS a0
  FROM d)
SELECT doc_id, size, n AS source_size, target,
       (greatest(0, least(floor(target + 0.5)::BIGINT, a0 + size) - a0)
        + greatest(0, least(floor(target + 0.5)::BIGINT, n + a0 + size) - (n + a0)))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

OP4 = r"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rule, rh, rp, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (
  SELECT page_id, host, path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY page_id, host, path
                            ORDER BY length(rh) + length(rp) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

_RATE = """
  (f_{r} + m_{r} * greatest(coalesce(m_{r} * (1 - m_{r})
     / nullif(greatest(q_{r} - m_{r} * m_{r} - m_{r} * (1 - m_{r}) * hosts / docs,
                       m_{r} * (1 - m_{r}) / 1000), 0) - 1, 0), 2))
  / (n + greatest(coalesce(m_{r} * (1 - m_{r})
     / nullif(greatest(q_{r} - m_{r} * m_{r} - m_{r} * (1 - m_{r}) * hosts / docs,
                       m_{r} * (1 - m_{r}) / 1000), 0) - 1, 0), 2)) <= 0.5"""
_HOST_RULES = ("short", "repeats", "symbols", "dup_lines")

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS seen
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1))) AS i)),
r AS (
  SELECT k, count(DISTINCT i + j) AS n
  FROM g, (SELECT unnest(range(0, 5)) AS j) WHERE seen > 1 GROUP BY k),
m AS (
  SELECT d.k, doc_id, source, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(lines) AS n_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r ON r.k = d.k),
f AS (
  SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
         100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 50 * n_lines AS dup_lines
  FROM m),
h AS (
  SELECT source, count(*)::DOUBLE AS n,
         {", ".join(f"sum({r}::INT)::DOUBLE AS f_{r}" for r in _HOST_RULES)}
  FROM f GROUP BY source),
p AS (
  SELECT sum(n) AS docs, count(*) AS hosts,
         {", ".join(f"sum(f_{r}) / sum(n) AS m_{r}, sum(f_{r} * f_{r} / n) / sum(n) AS q_{r}"
                    for r in _HOST_RULES)}
  FROM h),
v AS (
  SELECT source, {" AND ".join(_RATE.format(r=r) for r in _HOST_RULES)} AS ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short OR repeats AS base_failed, NOT (short OR repeats) AND ok AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

OP9 = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(degree.n, 0)::BIGINT AS n_links,
       least(vec_id, coalesce(lowest.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(lowest.b, vec_id)) AS kept
FROM embeddings m LEFT JOIN lowest ON lowest.a = m.vec_id LEFT JOIN degree ON degree.a = m.vec_id
"""

OP12 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES = {
    "op1_ngram_jaccard_join": OP1,
    "op2_source_mixing": OP2,
    "op5_host_quality_rules": OP5,
    "op9_lattice_near_dup": OP9,
    "op4_url_filter": OP4,
    "op12_extendible_hash_dedup": OP12,
    "op13_zone_map_negatives": OP13,
}
