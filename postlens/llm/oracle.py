"""The operators in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

SOURCE_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT s.*, ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE
               - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE)
              / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM sources s
  WINDOW before AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN level >= (2 * source_size)::DOUBLE / weight THEN (2 * source_size)::DOUBLE
              ELSE weight * (SELECT arg_min(level, (2 * source_size)::DOUBLE / weight) FROM levels
                             WHERE level < (2 * source_size)::DOUBLE / weight) END AS target
  FROM levels)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * size
        + least(size, greatest(0, round(target) - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size
                               - coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id
                                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
"""

LINE_RULES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
worded AS (
  SELECT doc_id, line, count(*) AS times, len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
by_line AS (
  SELECT doc_id, sum(times - 1)::BIGINT AS n_dup_lines,
         coalesce(sum(chars) FILTER (regexp_matches(line, '[.!?…:;"”»)][\x20\x09-\x0D]*\z')
           AND NOT regexp_matches(line, '(?:[^|›»]*[|›»]){3}')
           AND NOT regexp_matches(line, '(?:[^!]*!!){3}') AND NOT regexp_matches(line, '[#*$%&<>=~_]{3}')
           AND NOT regexp_matches(line, '(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie|javascript|lorem ipsum|licensed under|copyright|click here|sign up|log in|subscribe')), 0) AS stays
  FROM worded GROUP BY doc_id),
words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
found AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times FROM windows) WHERE times > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM found, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id),
facts AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words,
         len(regexp_replace(coalesce(d.text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(b.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(b.stays, 0) AS stays
  FROM documents d JOIN words w USING (doc_id) LEFT JOIN by_line b USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * (word_chars - stays) <= 50 * word_chars AS kept
FROM facts
"""

NGRAM_JOIN = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sizes s ON s.doc_id = p.a JOIN sizes t ON t.doc_id = p.b
  WHERE 100 * p.shared >= 85 * (s.n + t.n - p.shared)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = d.doc_id
"""

EMBEDDING_DEDUP = r"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m.low, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(m.low, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = e.vec_id
"""

#: crc32 has no function here, so it is computed from its polynomial, byte by byte, over the whole text.
SHARDING = r"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
bytes AS (
  SELECT text, list_transform(range(strlen(text)::BIGINT), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT text, hex(encode(text)) AS h FROM texts)),
sums AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM bytes, crc),
bids AS (
  SELECT doc_id, k, -1 / ln((('0x' || substr(md5(key || '@' || k), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS bid
  FROM (SELECT DISTINCT doc_id, coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-') AS key FROM documents), range(9) t(k)),
best AS (
  SELECT doc_id, arg_max(k, bid) FILTER (k < 8) AS shard, arg_max(k, bid) AS grown_shard FROM bids GROUP BY doc_id)
SELECT d.doc_id, strlen(coalesce(d.text, '')) + 1 AS size, s.text_crc32, 'key' AS law, b.shard::INT AS shard, b.grown_shard::INT AS grown_shard,
       row_number() OVER (PARTITION BY b.shard
         ORDER BY substr(md5(coalesce(length(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || '@-1'), 1, 13), d.doc_id NULLS FIRST, s.text_crc32, strlen(coalesce(d.text, ''))) - 1 AS slot
FROM documents d JOIN best b ON d.doc_id IS NOT DISTINCT FROM b.doc_id JOIN sums s ON s.text = coalesce(d.text, '')
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p
  FROM cells JOIN sizes USING (lang)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM cells GROUP BY lang, term) JOIN sizes USING (lang)),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // q.q
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""
