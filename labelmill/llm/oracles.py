"""SQL twins (DuckDB) of the queries that SQL can express; doc_id is unique there."""

from __future__ import annotations

from labelmill.llm.quality import POLICIES, RULES, mask

OP5 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS k FROM items) WHERE k > 0)),
places AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, k FROM places JOIN grams USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM words UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a
"""

_bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
OP8 = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)),
again AS (SELECT doc_id, g FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN again USING (doc_id, g)) GROUP BY 1),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines, length(regexp_replace(t, '\PL+', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper
  FROM base LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, CAST({_bits} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
       (failed & {mask(POLICIES["v2"])}) = 0 AS kept, failed FROM f
"""

OP9 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h, count(*) OVER (PARTITION BY doc_id) AS n FROM lines),
rolled AS (SELECT *, (lag(h) OVER d * 31 + h) % 1000003 AS r FROM hashed WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
ends AS (
  SELECT *, i > 0 AND i < n - 2 AND coalesce(r < lag(r) OVER d, true) AND r <= lead(r) OVER d AS last
  FROM rolled WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(CAST(last AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ends),
cut AS (SELECT doc_id, c, min(i) AS first, max(i) AS final, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY 1, 2),
around AS (
  SELECT *, coalesce(lag(first) OVER d, first) AS low, coalesce(lead(final) OVER d, final) AS high FROM cut WINDOW d AS (PARTITION BY doc_id ORDER BY c)),
chunks AS (SELECT *, count(*) OVER (PARTITION BY body) > 1 AS again FROM around WHERE final > first),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS k,
         first_value(doc_id) OVER w AS k_doc, first_value(first) OVER w AS k_first, first_value(final) OVER w AS k_final,
         first_value(low) OVER w AS k_low, first_value(high) OVER w AS k_high
  FROM chunks WHERE again AND regexp_matches(body, '[^\x20\x09-\x0D]') WINDOW w AS (PARTITION BY body ORDER BY doc_id, first)),
gone AS (
  SELECT g.*, NOT EXISTS (SELECT 1 FROM chunks x WHERE x.again AND x.doc_id = g.doc_id AND x.c = g.c - 1) AS free_before,
         NOT EXISTS (SELECT 1 FROM chunks x WHERE x.again AND x.doc_id = g.doc_id AND x.c = g.c + 1) AS free_after
  FROM ranked g WHERE k > 1),
before AS (
  SELECT g.doc_id, g.c, min(j) FILTER (WHERE a.line <> b.line) AS differs
  FROM (SELECT *, unnest(range(1, least(first - low, k_first - k_low) + 1)) AS j FROM gone WHERE free_before) g
  JOIN lines a ON a.doc_id = g.doc_id AND a.i = g.first - j JOIN lines b ON b.doc_id = g.k_doc AND b.i = g.k_first - j GROUP BY 1, 2),
after AS (
  SELECT g.doc_id, g.c, min(j) FILTER (WHERE a.line <> b.line) AS differs
  FROM (SELECT *, unnest(range(1, least(high - final, k_high - k_final) + 1)) AS j FROM gone WHERE free_after) g
  JOIN lines a ON a.doc_id = g.doc_id AND a.i = g.final + j JOIN lines b ON b.doc_id = g.k_doc AND b.i = g.k_final + j GROUP BY 1, 2),
removed AS (
  SELECT DISTINCT g.doc_id, unnest(range(
    first - CASE WHEN free_before THEN coalesce(x.differs - 1, least(first - low, k_first - k_low)) ELSE 0 END,
    final + CASE WHEN free_after THEN coalesce(y.differs - 1, least(high - final, k_high - k_final)) ELSE 0 END + 1)) AS i
  FROM gone g LEFT JOIN before x ON x.doc_id = g.doc_id AND x.c = g.c LEFT JOIN after y ON y.doc_id = g.doc_id AND y.c = g.c),
runs AS (SELECT doc_id, min(i) AS first, max(i) AS final FROM (
  SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM removed) GROUP BY doc_id, run),
spans AS (SELECT doc_id, CAST(sum(final - first + 1) AS BIGINT) AS n, string_agg(first || ':' || final, ',' ORDER BY first) AS s FROM runs GROUP BY 1),
rest AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS body FROM lines l LEFT JOIN removed g ON l.doc_id = g.doc_id AND l.i = g.i
  WHERE g.doc_id IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_removed,
       coalesce(s, '') AS removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(body, '') END AS text
FROM documents d LEFT JOIN spans USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

OP13 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
total AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT big_n FROM total) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held GROUP BY 1),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

ORACLES = {
    "op5_decontamination": OP5,
    "op6_near_dedup": OP6,
    "op8_quality_rules": OP8,
    "op9_line_dedup": OP9,
    "op13_ranked_search": OP13,
}
