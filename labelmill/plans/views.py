"""Input shapes over the given tables, as SQL both engines read alike.

Every view covers its whole base table.
"""

from __future__ import annotations

REVIEWS = """
SELECT d.doc_id AS row_id, d.text, d.lang, d.source,
       CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic,
       CASE WHEN l.quality IS NULL THEN NULL WHEN l.toxic = 1 THEN 'negative'
            WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS original_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# Repeated content: every good-quality review occurs a second time under a new id.
DIRTY_REVIEWS = """
SELECT * FROM reviews
UNION ALL
SELECT -1 - row_id AS row_id, text, lang, source, n_chars, quality, toxic, original_label
FROM reviews WHERE quality = 1
"""

# Stored labeller replies, good and bad.
RESPONSES = """
SELECT row_id, CASE row_id % 16
  WHEN 0 THEN 'not json'
  WHEN 1 THEN CONCAT('```json', CHR(10), '{"label": "positive", "confidence": 0.95}', CHR(10), '```')
  WHEN 2 THEN '{"confidence": 0.4}'
  WHEN 3 THEN '{"label": "neutral"}'
  WHEN 4 THEN '{"label": "negative", "confidence": "0.8"}'
  WHEN 5 THEN '{"label": "negative", "confidence": "high"}'
  WHEN 6 THEN '{"label": null, "confidence": 0.5}'
  WHEN 7 THEN '[1]'
  WHEN 8 THEN '{"label": "positive", "confidence": 0.9} trailing'
  WHEN 9 THEN '{"label": "neutral", "confidence": null}'
  WHEN 10 THEN ''
  WHEN 11 THEN CONCAT('{"label": "', COALESCE(original_label, 'neutral'), '", "confidence": 1}')
  ELSE '  {"label": "negative", "confidence": 0.65}  ' END AS raw
FROM reviews
"""

# Automatic labels with errors, missing labels and missing confidences.
LABELED = """
SELECT row_id, text, original_label AS human_label,
       CASE WHEN row_id % 17 = 0 THEN 'error' WHEN row_id % 23 = 0 THEN NULL
            WHEN row_id % 5 = 0 THEN 'neutral'
            ELSE COALESCE(original_label, 'positive') END AS label_auto,
       CASE WHEN row_id % 17 = 0 THEN CAST(0 AS DOUBLE) WHEN row_id % 29 = 0 THEN NULL
            ELSE CAST((row_id * 37) % 100 AS DOUBLE) / 100 END AS confidence
FROM reviews
"""

# A reviewer's answers for part of the queue.
CORRECTIONS = """
SELECT row_id AS row_index, text, 'neutral' AS label_auto, CAST(1 AS DOUBLE) AS confidence
FROM labeled WHERE confidence < 0.7 AND row_id % 3 <> 0
"""

# Search results named after pages, with repeated refs and missing descriptions.
HITS = """
SELECT page_id AS pos, page_id % 6 AS query_id,
       CASE WHEN page_id % 2 = 0 THEN 'HubA' ELSE 'HubB' END AS source,
       CONCAT(SUBSTR(url, 1, 18), '/set', CAST(LENGTH(html) % 60 AS VARCHAR(10))) AS ref,
       CONCAT(CASE LENGTH(html) % 7 WHEN 0 THEN 'Movie Review corpus: ' WHEN 1 THEN 'Sentiment tweets: '
            WHEN 2 THEN 'Street images: ' WHEN 3 THEN 'IMDB tables: ' WHEN 4 THEN 'Audio clips: '
            WHEN 5 THEN 'NLP starter: ' ELSE 'Weather: ' END,
            regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title,
       CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 13 = 0 THEN 'text classification set'
            ELSE CONCAT('files at ', url) END AS description
FROM pages
"""

# Three class probabilities per row, from the letters of its text.
PROBS = """
SELECT row_id, a / (a + b + c) AS p1, b / (a + b + c) AS p2, c / (a + b + c) AS p3
FROM (SELECT row_id, CAST(LENGTH(text) % 97 AS DOUBLE) AS a,
             CAST(LENGTH(REPLACE(text, 'e', '')) % 89 AS DOUBLE) AS b,
             CAST(LENGTH(REPLACE(text, 'n', '')) % 83 + 1 AS DOUBLE) AS c FROM reviews) x
"""

# Truth against prediction.
PREDICTIONS = """
SELECT row_id, human_label AS label, label_auto AS prediction
FROM labeled WHERE human_label IS NOT NULL AND label_auto IS NOT NULL AND label_auto <> 'error'
"""

# Learning histories: agreement of automatic and human labels in ten cells.
HISTORY = """
SELECT iteration, 15 + 10 * iteration AS n_labeled,
       AVG(hit) AS accuracy, AVG(hit) / 2 AS f1, strategy
FROM (SELECT CAST(row_id % 5 AS INT) AS iteration,
             CASE WHEN row_id % 2 = 0 THEN 'entropy' ELSE 'random' END AS strategy,
             CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit
      FROM predictions) x
GROUP BY iteration, strategy
"""

# (name, text) in dependency order.
VIEWS = {
    "reviews": REVIEWS,
    "dirty_reviews": DIRTY_REVIEWS,
    "responses": RESPONSES,
    "labeled": LABELED,
    "corrections": CORRECTIONS,
    "hits": HITS,
    "probs": PROBS,
    "predictions": PREDICTIONS,
    "history": HISTORY,
}

_NEEDS = {
    "reviews": [],
    "dirty_reviews": ["reviews"],
    "responses": ["reviews"],
    "labeled": ["reviews"],
    "corrections": ["reviews", "labeled"],
    "hits": [],
    "probs": ["reviews"],
    "predictions": ["reviews", "labeled"],
    "history": ["reviews", "labeled", "predictions"],
}


def with_views(names: list[str]) -> str:
    """CTE list that defines the named views and what they rest on."""
    wanted = {n for name in names for n in [name, *_NEEDS[name]]}
    parts = [f"{name} AS ({text.strip()})" for name, text in VIEWS.items() if name in wanted]
    return ",\n".join(parts)
