"""DuckDB SQL of the queries that SQL can express, written the plain way (strings, not hashes)."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
raw_lines AS (SELECT doc_id, source, text, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, {_KEY} AS k FROM raw_lines),
keyed AS (SELECT *, len(regexp_extract_all(k, '[^\x20\x09-\x0D]+')) AS n FROM lines WHERE length(k) > 0),
hosts AS (SELECT source, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS n FROM d GROUP BY source),
counts AS (SELECT source, k, count(DISTINCT text) AS n FROM keyed GROUP BY source, k),
frequent AS (
  SELECT c.source, c.k FROM counts c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n >= 3 AND c.n > h.n * 0.05::DOUBLE),
lost AS (
  SELECT l.doc_id, sum(l.n) AS n FROM keyed l JOIN frequent f
  ON l.source IS NOT DISTINCT FROM f.source AND l.k = f.k GROUP BY l.doc_id),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(u.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS n_boilerplate_words
  FROM d LEFT JOIN repeats r USING (doc_id) LEFT JOIN dups u USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_boilerplate_words > 0 AND (n_words - n_boilerplate_words < 10
           OR n_boilerplate_words > n_words * 0.8::DOUBLE) AS depleted
  FROM base)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM judged
"""

MIXING = rf"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix:' || doc_id) AS shuffle FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM totals),
fill(level, step) AS (
  SELECT 0::DOUBLE, 0
  UNION ALL
  SELECT (SELECT (sum(source_size) - coalesce(sum(CASE WHEN source_size * 3 <= w * f.level THEN source_size * 3 END), 0))::DOUBLE
                 / nullif(sum(CASE WHEN source_size * 3 > w * f.level THEN w END), 0)::DOUBLE FROM ranked), step + 1
  FROM fill f WHERE step < 60 AND level IS NOT NULL),
lvl AS (SELECT coalesce(max(level), 0) AS level FROM fill),
targets AS (
  SELECT source, source_size, least((source_size * 3)::DOUBLE, w * level) AS target FROM ranked, lvl),
queued AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS cum
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
items AS (
  SELECT doc_id, size, shuffle, e, (cum + source_size * e)::DOUBLE / target AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0 AND target > 0),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, shuffle, doc_id, e ROWS UNBOUNDED PRECEDING) AS total FROM items),
got AS (
  SELECT doc_id, count(*) AS epochs FROM ordered WHERE total <= (SELECT sum(size) FROM sizes) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, (coalesce(epochs, 0) * size)::BIGINT AS taken, coalesce(epochs, 0)::INT AS epochs
FROM queued LEFT JOIN got USING (doc_id)
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id::VARCHAR AS item, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

LINE_DEDUP = rf"""
WITH raw_lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS p, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
lines AS (SELECT *, {_KEY} AS k FROM raw_lines),
holders AS (SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT doc_id, p, line, h.first IS NOT NULL AND h.first <> doc_id AS gone FROM lines l LEFT JOIN holders h ON l.k = h.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0 AND a.r <> v.r),
p AS (
  SELECT a, anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST) AS k
  FROM s WHERE same QUALIFY k <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, k ORDER BY s.score DESC, s.id NULLS LAST)::INT AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
  QUALIFY rank <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n
"""

WARC = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts USING (payload_digest)
"""

SQL: dict[str, str] = {
    "op2_quality": QUALITY,
    "op5_mixing": MIXING,
    "op6_decontaminate": DECONTAMINATE,
    "op9_line_dedup": LINE_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_warc": WARC,
}
