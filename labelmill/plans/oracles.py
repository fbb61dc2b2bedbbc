"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from labelmill.functions.replies import WHITESPACE
from labelmill.operators.annotate import (
    CLASSES,
    GUIDE,
    MODEL,
    PROMPT_HEAD,
    PROMPT_TAIL,
    PROMPT_TEXT,
    TASK_FROM,
    TASK_TO,
    TASK_TYPE,
)
from labelmill.operators.catalog import SEARCH, TRANSLATION
from labelmill.operators.filters import TEXT_KEYWORDS
from labelmill.plans.views import with_views

ORACLES: dict[str, str] = {}


def lit(text: str) -> str:
    """SQL text literal; control characters are spelled as CHR calls."""
    parts, plain = [], ""
    for ch in text:
        if ch.isprintable():
            plain += ch.replace("'", "''")
        else:
            if plain:
                parts.append(f"'{plain}'")
            parts.append(f"CHR({ord(ch)})")
            plain = ""
    if plain or not parts:
        parts.append(f"'{plain}'")
    return parts[0] if len(parts) == 1 else f"({' || '.join(parts)})"


def oracle(name: str, body: str, views: str = "", ctes: str = "") -> None:
    parts = [p for p in (with_views(views.split()) if views else "", ctes.strip()) if p]
    ORACLES[name] = (f"WITH {', '.join(parts)} " if parts else "") + body.strip()


KEY = "substr(md5(concat('42:', CAST(row_id AS VARCHAR))), 1, 15), row_id"
LABELED = "row_id, text, human_label, label_auto, ROUND(confidence, 6) AS confidence"
LOW = "confidence < 0.7"

# --- sources and sinks ---

SHOWN_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
oracle("read_table", f"SELECT * REPLACE (ROUND(value, 6) AS value, {SHOWN_TS}) FROM events")
oracle("read_csv_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
oracle("first_usable_source", "SELECT text, role FROM conversations WHERE role <> 'error'")
oracle("write_table", f"SELECT {LABELED} FROM labeled", "labeled")
oracle("write_table_json", f"SELECT {LABELED} FROM labeled", "labeled")
oracle(
    "export_review_queue",
    f"""SELECT row_id AS row_index, text, label_auto, ROUND(confidence, 6) AS confidence
    FROM labeled WHERE {LOW}""",
    "labeled",
)
oracle("read_corrections", "SELECT row_index, text, label_auto, confidence FROM corrections", "corrections")
_good = "label_auto IS NOT NULL AND label_auto NOT IN ('', 'error')"
_tasks = ", ".join(
    f"CASE WHEN {_good} THEN {value} END AS {name}"
    for name, value in (
        ("model_version", lit(MODEL)), ("score", "ROUND(confidence, 6)"),
        ("from_name", lit(TASK_FROM)), ("to_name", lit(TASK_TO)), ("type", lit(TASK_TYPE)),
        ("choice", "label_auto"),
    )
)
for _name in ("write_tasks", "label_tasks"):
    oracle(_name, f"SELECT row_id AS id, text, {_tasks} FROM labeled", "labeled")
_summary = f"""SELECT COUNT(*) AS total,
  COUNT(*) FILTER (WHERE {LOW}) AS low_confidence,
  COUNT(*) FILTER (WHERE label_auto = 'error') AS errors,
  ROUND(AVG(confidence), 6) AS confidence_mean,
  ROUND(COUNT(*) FILTER (WHERE label_auto = 'error') / CAST(GREATEST(COUNT(*), 1) AS DOUBLE), 6)
    AS error_share
FROM labeled"""
for _name in ("write_metrics", "label_summary"):
    oracle(_name, _summary, "labeled")

# --- columns and filters ---

oracle(
    "normalize_columns",
    'SELECT doc_id, text, lang AS original_label, source AS "class", n_chars AS "Text_Chars" FROM documents',
)
oracle("resolve_columns", "SELECT conv_id, turn, text, role AS label FROM conversations")
oracle(
    "truncate_text",
    """SELECT row_id, substr(text, 1, 400) AS text,
    substr(COALESCE(original_label, 'nan'), 1, 60) AS original_label FROM reviews""",
    "reviews",
)
_words = "lower(COALESCE(description, '') || ' ' || COALESCE(title, ''))"


def _is_text(words: str) -> str:
    return "(" + " OR ".join(f"contains({words}, '{k}')" for k in TEXT_KEYWORDS) + ")"


oracle("filter_text_datasets", f"SELECT * FROM hits WHERE {_is_text(_words)}", "hits")
oracle("filter_low_confidence", f"SELECT {LABELED} FROM labeled WHERE {LOW}", "labeled")
_valid = "label_auto IS NOT NULL AND label_auto <> 'error'"
oracle("filter_valid_labels", f"SELECT {LABELED} FROM labeled WHERE {_valid}", "labeled")
oracle(
    "drop_error_labels",
    f"SELECT {LABELED} FROM labeled WHERE label_auto IS DISTINCT FROM 'error'",
    "labeled",
)
oracle(
    "drop_null_rows",
    f"SELECT {LABELED} FROM labeled WHERE label_auto IS NOT NULL AND confidence IS NOT NULL",
    "labeled",
)

# --- keyed joins ---

oracle(
    "take_rows",
    "SELECT * FROM reviews WHERE row_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "reviews",
)
oracle(
    "remove_rows",
    "SELECT * FROM reviews WHERE row_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "reviews",
)
MERGED = """SELECT l.row_id, CASE WHEN c.row_index IS NULL THEN l.text ELSE c.text END AS text,
  l.human_label,
  CASE WHEN c.row_index IS NULL THEN l.label_auto ELSE c.label_auto END AS label_auto,
  ROUND(CASE WHEN c.row_index IS NULL THEN l.confidence ELSE c.confidence END, 6) AS confidence
FROM labeled l LEFT JOIN corrections c ON l.row_id = c.row_index"""
oracle("apply_corrections", MERGED, "corrections")
oracle(
    "apply_corrections_replace",
    f"""SELECT {LABELED} FROM labeled WHERE confidence >= 0.7
    UNION ALL
    SELECT row_index, text, NULL, label_auto, confidence FROM corrections""",
    "corrections",
)
oracle("replace_with_reviewed_upsert", MERGED, "corrections")
oracle(
    "replace_with_reviewed",
    "SELECT row_index AS row_id, text, label_auto, confidence FROM corrections",
    "corrections",
)

# --- profile and cleaning ---

COLS = ("text", "lang", "source", "n_chars", "quality", "toxic", "original_label")
NUMERIC = ("n_chars", "quality", "toxic")


def _bounds(source: str, cols: tuple[str, ...], alias: str) -> str:
    """CTE with lo_c and hi_c per column."""
    parts = []
    for c in cols:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        parts.append(f"{q1} - 1.5 * ({q3} - {q1}) AS lo_{c}, {q3} + 1.5 * ({q3} - {q1}) AS hi_{c}")
    return f"{alias} AS (SELECT {', '.join(parts)} FROM {source})"


_sums = " + ".join(f"CAST({c} IS NULL AS INT)" for c in COLS)
_missing = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing,
    ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 1) AS pct FROM dirty_reviews"""
    for c in COLS
)
oracle("missing_counts", f"SELECT * FROM ({_missing}) WHERE missing > 0", "dirty_reviews")
_all = ", ".join(COLS)
DUPLICATES = f"""(SELECT COUNT(*) FROM dirty_reviews)
 - (SELECT COUNT(*) FROM (SELECT DISTINCT {_all} FROM dirty_reviews))"""
oracle("duplicate_count", f"SELECT {DUPLICATES} AS duplicates", "dirty_reviews")
oracle(
    "duplicate_count_times",
    """SELECT (SELECT COUNT(*) FROM events)
    - (SELECT COUNT(*) FROM (SELECT DISTINCT * EXCLUDE (event_id) FROM events)) AS duplicates""",
)
_outside = {c: f"COUNT(*) FILTER (WHERE {c} < lo_{c} OR {c} > hi_{c})" for c in NUMERIC}
oracle(
    "table_shape",
    f"""SELECT COUNT(*) AS rows, CAST({len(COLS)} AS BIGINT) AS cols,
    CAST(SUM({_sums}) AS BIGINT) AS missing_cells,
    {' + '.join(_outside.values())} AS outlier_cells FROM dirty_reviews, b""",
    "dirty_reviews",
    _bounds("dirty_reviews", NUMERIC, "b"),
)
oracle(
    "iqr_bounds",
    " UNION ALL ".join(
        f"""SELECT "column", ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q3 - q1, 6) AS iqr,
        ROUND(q1 - 1.5 * (q3 - q1), 6) AS lower, ROUND(q3 + 1.5 * (q3 - q1), 6) AS upper
        FROM (SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1,
              quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
oracle(
    "outlier_counts",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers
        FROM {t}, (SELECT quantile_cont({c}, 0.25) * 2.5 - quantile_cont({c}, 0.75) * 1.5 AS lo,
                   quantile_cont({c}, 0.75) * 2.5 - quantile_cont({c}, 0.25) * 1.5 AS hi FROM {t})"""
        for t, c in (("events", "value"), ("documents", "n_chars"), ("customer", "c_acctbal"))
    )
    + ") WHERE outliers > 0",
)


def _imbalance(cols: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", value, ROUND(n / total, 3) AS share
        FROM (SELECT {c} AS value, CAST(COUNT(*) AS DOUBLE) AS n,
              SUM(COUNT(*)) OVER () AS total, MAX(COUNT(*)) OVER () AS top
              FROM dirty_reviews WHERE {c} IS NOT NULL GROUP BY {c})
        WHERE CAST(top AS DOUBLE) / total > 0.8"""
        for c in cols
    )


STRINGS = ("text", "lang", "source", "original_label")
oracle("class_imbalance", _imbalance(STRINGS), "dirty_reviews")
oracle(
    "value_counts",
    """SELECT event_type AS value, COUNT(*) AS n,
    ROUND(COUNT(*) / CAST((SELECT COUNT(event_type) FROM events) AS DOUBLE), 6) AS share
    FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
)
TOP = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", value, n, position,
    CAST(FLOOR(n * 220 / MAX(n) OVER ()) AS INT) AS bar
    FROM (SELECT {c} AS value, CAST(COUNT(*) AS DOUBLE) AS n,
          ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) AS position
          FROM dirty_reviews WHERE {c} IS NOT NULL GROUP BY {c}) WHERE position <= 10"""
    for c in ("text", "lang")
)
oracle(
    "top_categories",
    f'SELECT "column", value, CAST(n AS BIGINT) AS n, CAST(position AS INT) AS position, bar FROM ({TOP})',
    "dirty_reviews",
)
oracle(
    "column_fill_values",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", ROUND(quantile_cont({c}, 0.5), 6) AS median,
        ROUND(AVG({c}), 6) AS mean FROM reviews"""
        for c in NUMERIC
    ),
    "reviews",
)


def _filled(source: str, fill: str, cols: tuple[str, ...] = NUMERIC) -> str:
    values = {
        c: f"COALESCE({c}, (SELECT {fill.format(c)} FROM {source})) AS {c}" if c in cols else c
        for c in COLS
    }
    return f"SELECT row_id, {', '.join(values.values())} FROM {source}"


def _deduped(source: str) -> str:
    return f"SELECT MIN(row_id) AS row_id, {_all} FROM {source} GROUP BY {_all}"


def _clipped(source: str, bounds: str) -> str:
    values = [
        f"CASE WHEN {c} IS NOT NULL THEN ROUND(LEAST(GREATEST({c}, lo_{c}), hi_{c}), 6) END AS {c}"
        if c in NUMERIC else c
        for c in COLS
    ]
    return f"SELECT row_id, {', '.join(values)} FROM {source}, {bounds}"


MEDIAN, MEAN = "quantile_cont({}, 0.5)", "AVG({})"
_shown = ", ".join(f"ROUND({c}, 6) AS {c}" if c in NUMERIC else c for c in COLS)
oracle(
    "impute_median",
    f"SELECT row_id, {_shown} FROM ({_filled('dirty_reviews', MEDIAN)})", "dirty_reviews",
)
oracle(
    "impute_mean",
    f"SELECT row_id, {_shown} FROM ({_filled('dirty_reviews', MEAN)})", "dirty_reviews",
)
oracle(
    "drop_missing",
    "SELECT * FROM dirty_reviews WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in COLS),
    "dirty_reviews",
)
oracle("drop_duplicates", _deduped("dirty_reviews"), "dirty_reviews")
oracle(
    "clip_iqr",
    f"""SELECT * EXCLUDE (lo_value, hi_value)
    REPLACE (ROUND(LEAST(GREATEST(value, lo_value), hi_value), 6) AS value, {SHOWN_TS}) FROM events, b""",
    ctes=_bounds("events", ("value",), "b"),
)
oracle(
    "remove_outliers",
    "SELECT * EXCLUDE (lo_toxic, hi_toxic) FROM s2, b3 WHERE toxic BETWEEN lo_toxic AND hi_toxic",
    "reviews",
    f"""{_bounds("reviews", ("n_chars",), "b1")},
    s1 AS (SELECT reviews.* FROM reviews, b1 WHERE n_chars BETWEEN lo_n_chars AND hi_n_chars),
    {_bounds("s1", ("quality",), "b2")},
    s2 AS (SELECT s1.* FROM s1, b2 WHERE quality BETWEEN lo_quality AND hi_quality),
    {_bounds("s2", ("toxic",), "b3")}""",
)
CLEANED = f"""filled AS ({_filled("dirty_reviews", MEDIAN)}),
deduped AS ({_deduped("filled")}),
{_bounds("deduped", NUMERIC, "cb")},
cleaned AS ({_clipped("deduped", "cb")})"""
oracle("clean", "SELECT * FROM cleaned", "dirty_reviews", CLEANED)
oracle(
    "clean_remove",
    f"SELECT row_id, {_shown} FROM s1, b2 WHERE quality BETWEEN lo_quality AND hi_quality",
    "dirty_reviews",
    f"""filled AS ({_filled("dirty_reviews", MEAN, ("n_chars", "quality"))}),
    deduped AS ({_deduped("filled")}), {_bounds("deduped", ("n_chars",), "b")},
    s1 AS (SELECT deduped.* FROM deduped, b WHERE n_chars BETWEEN lo_n_chars AND hi_n_chars),
    {_bounds("s1", ("quality",), "b2")}""",
)


oracle(
    "clean_remove_all",
    f"SELECT row_id, {_shown} FROM s2, b3 WHERE toxic BETWEEN lo_toxic AND hi_toxic",
    "dirty_reviews",
    f"""filled AS ({_filled("dirty_reviews", MEAN)}),
    deduped AS ({_deduped("filled")}), {_bounds("deduped", ("n_chars",), "b")},
    s1 AS (SELECT deduped.* FROM deduped, b WHERE n_chars BETWEEN lo_n_chars AND hi_n_chars),
    {_bounds("s1", ("quality",), "b2")},
    s2 AS (SELECT s1.* FROM s1, b2 WHERE quality BETWEEN lo_quality AND hi_quality),
    {_bounds("s2", ("toxic",), "b3")}""",
)


def _totals(source: str) -> str:
    return f"""SELECT 'Rows' AS metric, COUNT(*) AS n FROM {source}
    UNION ALL SELECT 'Missing values', CAST(SUM({_sums}) AS BIGINT) FROM {source}
    UNION ALL SELECT 'Duplicate rows', (SELECT COUNT(*) FROM {source})
      - (SELECT COUNT(*) FROM (SELECT DISTINCT {_all} FROM {source}))"""


COMPARED = f"""compared AS (
SELECT b.metric, b.n AS before, a.n AS after,
  CASE WHEN a.n <= b.n THEN 'better' ELSE 'worse' END AS verdict
FROM ({_totals("dirty_reviews")}) b JOIN ({_totals("cleaned")}) a ON a.metric = b.metric)"""
oracle("compare_tables", "SELECT * FROM compared", "dirty_reviews", f"{CLEANED}, {COMPARED}")
_tall = "CAST({} AS DOUBLE)"
_issues = [
    f"SELECT 'shape' AS section, 'table' AS key, '{m}' AS metric, {_tall.format(v)} AS value, "
    f"CAST(NULL AS VARCHAR) AS text FROM dirty_reviews, rb"
    for m, v in (
        ("rows", "COUNT(*)"), ("cols", f"MAX({len(COLS)})"), ("missing_cells", f"SUM({_sums})"),
        ("outlier_cells", " + ".join(_outside.values())),
    )
] + [f"SELECT 'shape', 'table', 'duplicates', {_tall.format(f'({DUPLICATES})')}, NULL"]
_issues += [
    f"""SELECT 'missing', "column", '{m}', {_tall.format(c)}, NULL FROM ({_missing}) WHERE missing > 0"""
    for m, c in (("count", "missing"), ("pct", "pct"))
]
_issues += [
    f"""SELECT 'outliers', '{c}', 'count', {_tall.format(n)}, NULL
    FROM dirty_reviews, rb HAVING {n} > 0"""
    for c, n in _outside.items()
]
_issues.append(
    f"""SELECT 'imbalance', "column", 'share', share, value FROM ({_imbalance(STRINGS)})"""
)
RAW_BOUNDS = _bounds("dirty_reviews", NUMERIC, "rb")
oracle("detect_issues", " UNION ALL ".join(_issues), "dirty_reviews", RAW_BOUNDS)
oracle("build_strategy_prompt", " UNION ALL ".join(_issues), "dirty_reviews", RAW_BOUNDS)
_report = [
    *_issues,
    *[
        f"SELECT 'strategy', '{k}', 'choice', NULL, '{v}'"
        for k, v in (("missing", "median"), ("duplicates", "drop"), ("outliers", "clip_iqr"))
    ],
    f"SELECT 'compare', metric, 'before', {_tall.format('before')}, NULL FROM compared",
    f"SELECT 'compare', metric, 'after', {_tall.format('after')}, verdict FROM compared",
    f"""SELECT 'categories', "column", CAST(position AS VARCHAR), n, value FROM ({TOP})""",
    *[
        f"SELECT 'sample', CAST(row_id AS VARCHAR), '{c}', "
        + (f"{c}, NULL" if c in NUMERIC else f"NULL, {c}")
        + " FROM (SELECT * FROM cleaned ORDER BY row_id LIMIT 5)"
        for c in COLS
    ],
]
oracle(
    "quality_report",
    f"SELECT section, key, metric, ROUND(value, 6) AS value, text FROM ({' UNION ALL '.join(_report)})",
    "dirty_reviews",
    f"{RAW_BOUNDS}, {CLEANED}, {COMPARED}",
)

# --- order ---

oracle("head_rows", "SELECT * FROM reviews ORDER BY row_id LIMIT 100", "reviews")
oracle(
    "seeded_shuffle",
    f"SELECT row_id, text, ROW_NUMBER() OVER (ORDER BY {KEY}) - 1 AS position FROM reviews",
    "reviews",
)
oracle(
    "sample_k",
    f"SELECT * FROM reviews WHERE original_label IS NOT NULL ORDER BY {KEY} LIMIT 10",
    "reviews",
)
_whole = lambda share: f"CAST(FLOOR({share} * n) AS BIGINT)"
oracle(
    "part_sizes",
    f"""SELECT lang, 'seed_pool' AS rule, 'seed' AS part, LEAST(n, GREATEST(10, {_whole(0.6)})) AS size FROM counted
    UNION ALL SELECT lang, 'seed_pool', 'pool', NULL FROM counted
    UNION ALL SELECT lang, 'learning', 'labeled', LEAST(50, CAST(FLOOR(0.5 * rest) AS BIGINT)) FROM rested
    UNION ALL SELECT lang, 'learning', 'pool', rest - LEAST(50, CAST(FLOOR(0.5 * rest) AS BIGINT)) FROM rested
    UNION ALL SELECT lang, 'learning', 'test', NULL FROM counted
    UNION ALL SELECT lang, 'adaptive', 'labeled', start FROM started
    UNION ALL SELECT lang, 'adaptive', 'pool', rest - start FROM started
    UNION ALL SELECT lang, 'adaptive', 'test', NULL FROM counted
    UNION ALL SELECT lang, 'adaptive', 'batch', CASE WHEN rest - start < batch THEN GREATEST(1, (rest - start) // 5) ELSE batch END FROM started""",
    "reviews",
    f"""counted AS (SELECT lang, COUNT(*) AS n FROM reviews GROUP BY lang),
    rested AS (SELECT lang, GREATEST(n - GREATEST(50, {_whole(0.2)}), 0) AS rest FROM counted),
    started AS (
      SELECT lang, rest, LEAST(rest, GREATEST(10, {_whole(0.15)})) AS start, GREATEST(3, {_whole(0.05)}) AS batch
      FROM (SELECT lang, n, GREATEST(n - GREATEST(15, {_whole(0.2)}), 0) AS rest FROM counted))""",
)
oracle(
    "split_by_rank",
    """SELECT row_id, original_label,
    CASE WHEN rn <= LEAST(50, FLOOR(0.5 * rest)) THEN 'labeled'
         WHEN rn <= rest THEN 'pool' ELSE 'test' END AS part
    FROM (SELECT *, GREATEST(n - GREATEST(50, CAST(FLOOR(0.2 * n) AS BIGINT)), 0) AS rest FROM ranked)""",
    "reviews",
    f"""ranked AS (SELECT row_id, original_label, COUNT(*) OVER () AS n,
    ROW_NUMBER() OVER (ORDER BY {KEY}) AS rn FROM reviews WHERE original_label IS NOT NULL)""",
)
_first5 = "ROW_NUMBER() OVER (PARTITION BY query_id, source ORDER BY pos) <= 5"
oracle("top_k_per_group", f"SELECT * FROM hits QUALIFY {_first5}", "hits")
oracle(
    "concat_tables",
    """SELECT row_id, text, lang, NULL AS label_auto, NULL AS confidence FROM reviews
    UNION ALL SELECT row_index, text, NULL, label_auto, confidence FROM corrections""",
    "corrections",
)

# --- catalogue ---

_records = """SELECT pos, query_id, source, ref, title, COALESCE(description, '') AS description,
  CASE source WHEN 'HubA' THEN 'https://a.example/' WHEN 'HubB' THEN 'https://b.example/'
  ELSE '' END || ref AS url, '' AS size_mb FROM {}"""
_first = "ROW_NUMBER() OVER (PARTITION BY url ORDER BY pos) = 1"
oracle("catalog_records", _records.format("hits"), "hits")
oracle("dedup_by_key", f"SELECT * FROM ({_records.format('hits')}) QUALIFY {_first}", "hits")
oracle("limit_catalog", "SELECT * FROM hits ORDER BY pos LIMIT 50", "hits")
oracle(
    "pick_preferred",
    """SELECT * FROM hits WHERE source = 'HubB'
    ORDER BY CASE WHEN regexp_matches(lower(title), 'sentiment|review|imdb') THEN 0 ELSE 1 END, pos
    LIMIT 1""",
    "hits",
)
oracle(
    "build_catalog",
    f"""SELECT pos, source, title, description, url, ref, size_mb
    FROM (SELECT * FROM ({_records.format('top5')}) QUALIFY {_first})
    WHERE {_is_text("lower(description || ' ' || title)")} ORDER BY pos LIMIT 50""",
    "hits",
    f"top5 AS (SELECT * FROM hits QUALIFY {_first5})",
)
oracle(
    "build_search_prompts",
    f"""SELECT item_id, {lit(SEARCH.format(n=6))} || text AS prompt, 'search' AS kind FROM benchmark
    UNION ALL SELECT item_id, {lit(TRANSLATION)} || text, 'translation' FROM benchmark""",
)
_breaks = lit("\r\n") + " || '|[' || " + lit("\n\x0b\x0c\r\x1c\x1d\x1e\x85  ") + " || ']'"
oracle(
    "split_queries",
    f"""SELECT doc_id, CAST(line AS INT) AS line, trim(trim(query, '- '), {lit(WHITESPACE)}) AS query
    FROM (SELECT doc_id, unnest(lines) AS query, unnest(range(len(lines))) AS line
          FROM (SELECT doc_id, string_split_regex(
                  '- ' || replace(text, CHR(10), CHR(10) || '- '), {_breaks}) AS lines
                FROM documents))
    WHERE trim(query, {lit(WHITESPACE)}) <> ''""",
)

# --- labelling ---

oracle(
    "build_label_prompts",
    f"""SELECT row_id, {lit(PROMPT_HEAD + ', '.join(CLASSES) + PROMPT_TEXT)}
    || substr(text, 1, 500) || {lit(PROMPT_TAIL)} AS prompt FROM reviews""",
    "reviews",
)
_ws = lit(WHITESPACE)
PARSED = f"""stripped AS (
  SELECT row_id, raw, trim(ltrim(trim(trim(raw, {_ws}), '`'), 'json'), {_ws}) AS body FROM responses),
objects AS (
  SELECT row_id, raw, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM stripped),
fields AS (
  SELECT row_id, raw, json_type(j) AS kind, json_extract(j, '$.label') AS l,
         json_extract_string(j, '$.label') AS label,
         json_extract(j, '$.confidence') AS c, json_type(json_extract(j, '$.confidence')) AS c_kind,
         json_extract_string(j, '$.confidence') AS c_text FROM objects),
numbers AS (
  SELECT row_id, raw, kind, l, label,
         CASE WHEN c IS NULL THEN CAST(0 AS DOUBLE)
              WHEN c_kind = 'BOOLEAN' THEN CAST(c_text = 'true' AS INT)
              WHEN c_kind IN ('ARRAY', 'OBJECT', 'NULL') THEN NULL
              ELSE TRY_CAST(c_text AS DOUBLE) END AS number FROM fields),
parsed AS (
  SELECT row_id, raw,
         CASE WHEN COALESCE(kind = 'OBJECT', FALSE) AND number IS NOT NULL
              THEN CASE WHEN l IS NULL THEN 'error' ELSE label END ELSE 'error' END AS label_auto,
         CASE WHEN COALESCE(kind = 'OBJECT', FALSE) AND number IS NOT NULL
              THEN ROUND(number, 6) ELSE CAST(0 AS DOUBLE) END AS confidence FROM numbers)"""
oracle("parse_label_responses", "SELECT row_id, raw, label_auto, confidence FROM parsed", "responses", PARSED)
oracle(
    "build_guide_prompt",
    f"""SELECT {lit(GUIDE.format(task="sentiment classification", labels=", ".join(CLASSES), language="Russian"))}
    || CAST(to_json(list(text ORDER BY row_id)) AS VARCHAR) AS prompt
    FROM (SELECT row_id, text FROM reviews WHERE text IS NOT NULL ORDER BY {KEY} LIMIT 10)""",
    "reviews",
)
_quality = """ROUND(AVG(confidence), 6) AS confidence_mean,
  ROUND(AVG(CASE WHEN confidence < 0.7 THEN 1.0 ELSE 0.0 END), 6) AS confidence_low_pct,
  ROUND(AVG(CASE WHEN label_auto = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate,
  ROUND(AVG(CASE WHEN label_auto = {0} THEN 1.0 ELSE 0.0 END)
    FILTER (WHERE label_auto IS DISTINCT FROM 'error'), 6) AS agreement"""
oracle("label_quality", f"SELECT {_quality.format('human_label')} FROM labeled", "labeled")
_auto = """SELECT r.*, p.label_auto, p.confidence
FROM reviews r JOIN parsed p ON p.row_id = r.row_id"""
oracle("auto_label", _auto, "responses", PARSED)
oracle(
    "auto_label_strict",
    """SELECT r.*, CASE WHEN known THEN p.label_auto ELSE 'error' END AS label_auto,
    CASE WHEN known THEN p.confidence ELSE 0 END AS confidence
    FROM reviews r JOIN (SELECT *, COALESCE(label_auto IN ('positive', 'neutral'), TRUE) AS known
                         FROM parsed) p ON p.row_id = r.row_id""",
    "responses", PARSED,
)
oracle(
    "annotate_label_dist",
    f"""SELECT label_auto AS value, COUNT(*) AS n,
    ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share
    FROM ({_auto}) WHERE label_auto IS NOT NULL GROUP BY label_auto""",
    "responses", PARSED,
)
oracle(
    "annotate", f"SELECT {_quality.format('original_label')} FROM ({_auto})", "responses", PARSED
)

ORACLES["annotate_guide_prompt"] = ORACLES["build_guide_prompt"]
oracle("annotate_tasks", f"SELECT row_id AS id, text, {_tasks} FROM ({_auto})", "responses", PARSED)
oracle(
    "reply_store",
    """SELECT row_id, CASE LENGTH(prompt) % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS label_auto,
    ROUND(CAST(LENGTH(prompt) % 100 AS DOUBLE) / 100, 6) AS confidence,
    (SELECT COUNT(DISTINCT prompt) FROM prompts) AS asked FROM prompts""",
    "dirty_reviews",
    f"""prompts AS (SELECT row_id, {lit(PROMPT_HEAD + ', '.join(CLASSES) + PROMPT_TEXT)}
    || substr(text, 1, 500) || {lit(PROMPT_TAIL)} AS prompt FROM dirty_reviews)""",
)

# --- features ---

TERMS = r"""tokens AS (
SELECT row_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS terms FROM reviews)"""
VOCABULARY = """counts AS (
  SELECT row_id, term, COUNT(*) AS tf
  FROM (SELECT row_id, unnest(terms) AS term FROM tokens) GROUP BY row_id, term),
vocabulary AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY term) - 1 AS INT) AS ix, term, doc_freq, total,
         LN((1 + (SELECT COUNT(*) FROM reviews)) / CAST(1 + doc_freq AS DOUBLE)) + 1 AS idf
  FROM (SELECT term, COUNT(*) AS doc_freq, CAST(SUM(tf) AS BIGINT) AS total FROM counts
        GROUP BY term ORDER BY total DESC, term LIMIT 5000))"""
oracle(
    "tokenize",
    "SELECT row_id, len(terms) AS n_terms, array_to_string(terms, ' ') AS terms FROM tokens",
    "reviews", TERMS,
)
oracle(
    "tfidf_fit",
    "SELECT ix, term, doc_freq, total, ROUND(idf, 6) AS idf FROM vocabulary",
    "reviews", f"{TERMS}, {VOCABULARY}",
)
oracle(
    "tfidf_transform",
    """SELECT row_id, term, ROUND(w / SQRT(SUM(w * w) OVER (PARTITION BY row_id)), 6) AS weight
    FROM (SELECT c.row_id, c.term, (1 + LN(c.tf)) * v.idf AS w
          FROM counts c JOIN vocabulary v ON v.term = c.term)""",
    "reviews", f"{TERMS}, {VOCABULARY}",
)

# --- stored coefficients ---

LABELLED_TERMS = TERMS.replace("FROM reviews)", "FROM reviews WHERE original_label IS NOT NULL)")
LABELLED_WEIGHTS = VOCABULARY.replace("FROM reviews)", "FROM tokens)") + """,
weights AS (
  SELECT row_id, term, w / SQRT(SUM(w * w) OVER (PARTITION BY row_id)) AS weight
  FROM (SELECT c.row_id, c.term, (1 + LN(c.tf)) * v.idf AS w FROM counts c JOIN vocabulary v ON v.term = c.term)),
parts AS (
  SELECT row_id, original_label, CASE WHEN rn <= LEAST(50, FLOOR(0.5 * rest)) THEN 'labeled' WHEN rn <= rest THEN 'pool' ELSE 'test' END AS part
  FROM (SELECT *, GREATEST(n - GREATEST(50, CAST(FLOOR(0.2 * n) AS BIGINT)), 0) AS rest
        FROM (SELECT row_id, original_label, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY """ + KEY + """) AS rn
              FROM reviews WHERE original_label IS NOT NULL)))"""


def _scored(train: str) -> str:
    """Centroids of the rows that ``train`` names, and every labelled row's class probabilities."""
    return f"""classes AS (SELECT original_label AS class, COUNT(*) AS n FROM parts WHERE {train} GROUP BY 1),
coefs AS (
  SELECT c.class, w.term, SUM(w.weight) * 8.0 / ANY_VALUE(c.n) AS coef
  FROM weights w JOIN parts p ON p.row_id = w.row_id JOIN classes c ON c.class = p.original_label WHERE {train} GROUP BY 1, 2),
summed AS (
  SELECT w.row_id, c.class, SUM(w.weight * c.coef) AS s FROM weights w JOIN coefs c ON c.term = w.term GROUP BY 1, 2),
scored AS (
  SELECT p.row_id, p.original_label, p.part, c.class, EXP(COALESCE(s.s, 0)) AS e
  FROM parts p CROSS JOIN classes c LEFT JOIN summed s ON s.row_id = p.row_id AND s.class = c.class),
predicted AS (
  SELECT row_id, ANY_VALUE(original_label) AS label, ANY_VALUE(part) AS part, FIRST(class ORDER BY e DESC, class) AS prediction,
         {", ".join(f"SUM(e) FILTER (WHERE class = '{c}') / SUM(e) AS p_{c}" for c in ("negative", "neutral", "positive"))}
  FROM scored GROUP BY row_id)"""


_probs = ", ".join(f"ROUND(p_{c}, 6) AS p_{c}" for c in ("negative", "neutral", "positive"))
oracle("predict_stored", f"SELECT row_id, label AS original_label, prediction, {_probs} FROM predicted", "reviews", f"{LABELLED_TERMS}, {LABELLED_WEIGHTS}, {_scored('TRUE')}")
oracle("save_scorer", f"SELECT row_id, prediction, {_probs} FROM predicted", "reviews", f"{LABELLED_TERMS}, {LABELLED_WEIGHTS}, {_scored('TRUE')}")
_train = "part <> 'test'"
oracle(
    "evaluate_stored",
    """SELECT ROUND((SELECT AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM tested), 6) AS accuracy,
    ROUND(AVG(2.0 * tp / (2 * tp + fp + fn)), 6) AS f1
    FROM (SELECT c, COUNT(*) FILTER (WHERE label = c AND prediction = c) AS tp,
                 COUNT(*) FILTER (WHERE label <> c AND prediction = c) AS fp,
                 COUNT(*) FILTER (WHERE label = c AND prediction <> c) AS fn
          FROM tested, (SELECT label AS c FROM tested UNION SELECT prediction FROM tested) GROUP BY c)""",
    "reviews", f"{LABELLED_TERMS}, {LABELLED_WEIGHTS}, {_scored(_train)}, tested AS (SELECT * FROM predicted WHERE part = 'test')",
)


def _random_pick(i: int) -> str:
    """The ten rows of the pool, less those picked before, with the highest number of this iteration."""
    score = f"CAST(('0x' || substr(md5(concat('42:{i}:', CAST(row_id AS VARCHAR))), 1, 13)) AS BIGINT)"
    before = "".join(f" AND row_id NOT IN (SELECT row_id FROM pick{j})" for j in range(i))
    return f"pick{i} AS (SELECT row_id FROM parts WHERE part = 'pool'{before} ORDER BY ROUND({score} / CAST(4503599627370496 AS DOUBLE), 12) DESC, row_id LIMIT 10)"


oracle(
    "al_cycle_random_picks",
    " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS iteration, row_id FROM pick{i}" for i in range(2)),
    "reviews", f"{LABELLED_TERMS}, {LABELLED_WEIGHTS}, {_random_pick(0)}, {_random_pick(1)}",
)

# --- scores and queries ---

_plnp = " + ".join(f"CASE WHEN p{i} > 0 THEN p{i} * LN(p{i}) ELSE 0 END" for i in (1, 2, 3))
_mid = "(p1 + p2 + p3 - GREATEST(p1, p2, p3) - LEAST(p1, p2, p3))"
SCORE = {
    "entropy": f"-({_plnp})",
    "margin": f"{_mid} - GREATEST(p1, p2, p3)",
    "random": "CAST(('0x' || substr(md5(concat('42:', CAST(row_id AS VARCHAR))), 1, 13)) AS BIGINT)"
    " / CAST(4503599627370496 AS DOUBLE)",
}
for _name, _score in SCORE.items():
    oracle(f"{_name}_score", f"SELECT row_id, ROUND({_score}, 6) AS score FROM probs", "probs")
    oracle(
        f"query_pool_{_name}",
        f"""SELECT row_id, ROUND(score, 6) AS score
        FROM (SELECT row_id, {_score} AS score FROM probs)
        ORDER BY ROUND(score, 12) DESC, row_id LIMIT 25""",
        "probs",
    )

oracle(
    "query_pool_missing",
    f"""SELECT row_id, ROUND(score, 6) AS score
    FROM (SELECT row_id, CASE WHEN row_id % 3 <> 0 THEN {SCORE['margin']} END AS score FROM probs)
    ORDER BY ROUND(score, 12) DESC NULLS LAST, row_id
    LIMIT (SELECT COUNT(*) - COUNT(*) // 5 FROM probs)""",
    "probs",
)

# --- metrics and histories ---

oracle(
    "classification_metrics",
    """SELECT ROUND((SELECT AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM predictions), 6)
      AS accuracy, ROUND(AVG(2.0 * tp / (2 * tp + fp + fn)), 6) AS f1
    FROM (SELECT c, COUNT(*) FILTER (WHERE label = c AND prediction = c) AS tp,
                 COUNT(*) FILTER (WHERE label <> c AND prediction = c) AS fp,
                 COUNT(*) FILTER (WHERE label = c AND prediction <> c) AS fn
          FROM predictions, (SELECT label AS c FROM predictions UNION
                             SELECT prediction FROM predictions) GROUP BY c)""",
    "predictions",
)
SAVINGS = """goal AS (SELECT MAX(accuracy) * 0.98 AS target FROM history WHERE strategy = 'random'),
reached AS (
  SELECT target,
    (SELECT arg_min(n_labeled, iteration) FROM history WHERE strategy = 'entropy' AND accuracy >= target) AS e,
    (SELECT arg_min(n_labeled, iteration) FROM history WHERE strategy = 'random' AND accuracy >= target) AS r
  FROM goal),
savings AS (
  SELECT ROUND(target, 4) AS target_accuracy, e AS n_labeled_entropy, r AS n_labeled_random,
    r - e AS samples_saved, ROUND((r - e) / CAST(r AS DOUBLE) * 100, 1) AS savings_pct FROM reached)"""
oracle("sample_savings", "SELECT * FROM savings", "history", SAVINGS)
oracle(
    "sample_savings_target", "SELECT * FROM savings", "history",
    SAVINGS.replace("SELECT MAX(accuracy) * 0.98 AS target FROM history WHERE strategy = 'random'", "SELECT CAST(0.5 AS DOUBLE) AS target"),
)
oracle(
    "write_learning_report",
    """SELECT CAST(10 AS BIGINT) AS batch_size, strategy, iteration, n_labeled,
    ROUND(accuracy, 6) AS accuracy, ROUND(f1, 6) AS f1 FROM history""",
    "history",
)
oracle(
    "learning_curve_pivot",
    "SELECT n_labeled, "
    + ", ".join(
        f"ROUND(AVG({m}) FILTER (WHERE strategy = '{s}'), 4) AS {s}_{m}"
        for s in ("entropy", "random")
        for m in ("accuracy", "f1")
    )
    + " FROM history GROUP BY n_labeled",
    "history",
)
oracle(
    "union_histories",
    """SELECT iteration, n_labeled, ROUND(accuracy, 6) AS accuracy, ROUND(f1, 6) AS f1, strategy
    FROM history""",
    "history",
)

# --- reports ---

STAGES = f"""{CLEANED},
merged AS ({MERGED}),
final AS (SELECT * FROM merged WHERE label_auto IS DISTINCT FROM 'error'),
summary AS ({_summary}),
valid AS (SELECT COUNT(*) AS n, GREATEST(10, FLOOR(0.6 * COUNT(*))) AS seed
          FROM merged WHERE {_valid})"""


def _metric(step: str, name: str, value: str, source: str = "", text: str = "NULL") -> str:
    head = f"SELECT '{step}' AS step, '{name}' AS metric, CAST({value} AS DOUBLE) AS value"
    return f"{head}, CAST({text} AS VARCHAR) AS text{' FROM ' + source if source else ''}"


def _dist(step: str) -> str:
    return _metric(step, "label_dist", "COUNT(*)", "labeled", "label_auto") + (
        " WHERE label_auto IS NOT NULL GROUP BY label_auto"
    )


_steps = [
    _metric("collect", "rows", "COUNT(*)", "dirty_reviews"),
    _metric("collect", "cols", str(len(COLS))),
    _metric("clean", "rows_before", "COUNT(*)", "dirty_reviews"),
    _metric("clean", "rows_after", "COUNT(*)", "cleaned"),
    _metric("clean", "duplicates_removed", f"({DUPLICATES})"),
    *[
        _metric("clean", f"strategy_{k}", "NULL", text=f"'{v}'")
        for k, v in (("missing", "median"), ("duplicates", "drop"), ("outliers", "clip_iqr"))
    ],
    _metric("clean_review", "action", "NULL", text="'approved'"),
    _metric("clean_review", "rows", "COUNT(*)", "cleaned"),
    *[
        _metric("annotate", c, f"ROUND({c}, 6)", "summary")
        for c in ("total", "low_confidence", "errors", "confidence_mean")
    ],
    _dist("annotate"),
    _metric("review", "action", "NULL", text="'corrected'"),
    _metric("review", "low_conf", "low_confidence", "summary"),
    _metric("review", "corrected", "COUNT(*)", "corrections"),
    _metric("al_select", "seed", "CASE WHEN n >= 20 THEN seed END", "valid"),
    _metric("al_select", "pool", "CASE WHEN n >= 20 THEN n - seed END", "valid"),
    _metric("al_select", "selected", "CASE WHEN n >= 20 THEN LEAST(50, n - seed) ELSE n END", "valid"),
    _metric("al_select", "total", "CASE WHEN n >= 20 THEN seed + LEAST(50, n - seed) ELSE n END", "valid"),
    _metric("al_select", "strategy", "NULL", "valid", "CASE WHEN n >= 20 THEN 'entropy' ELSE 'passthrough' END"),
    _metric("al_review", "action", "NULL", text="'skipped'"),
    _metric("al_review", "shown", "COUNT(*)", "final"),
    _metric("al_review", "corrected", "0"),
]
_last = "history WHERE strategy = 'entropy'"
_steps += [
    _metric("train", c, f"ROUND(arg_max({c}, iteration), 6)", _last)
    for c in ("accuracy", "f1", "n_labeled")
] + [
    _metric("train", c, c, "savings")
    for c in ("target_accuracy", "n_labeled_entropy", "n_labeled_random", "samples_saved", "savings_pct")
]
oracle(
    "run_metrics", " UNION ALL ".join(_steps), "dirty_reviews corrections history",
    f"{STAGES}, {SAVINGS}",
)
_card = [
    _metric("card", "raw", "COUNT(*)", "dirty_reviews"),
    _metric("card", "clean", "COUNT(*)", "cleaned"),
    _metric("card", "labeled", "COUNT(*)", "labeled"),
    _metric("card", "final", "COUNT(*)", "final"),
    _dist("card"),
]
oracle("data_card", " UNION ALL ".join(_card), "dirty_reviews corrections", STAGES)
_final = [
    _metric("stages", "rows_collected", "COUNT(*)", "dirty_reviews"),
    _metric("stages", "duplicates_removed", f"({DUPLICATES})"),
    _metric("stages", "rows_clean", "COUNT(*)", "cleaned"),
    _metric("stages", "rows_labeled", "total", "summary"),
    _metric("stages", "confidence_mean", "ROUND(confidence_mean, 3)", "summary"),
    _metric("stages", "error_share", "error_share", "summary"),
    _metric("stages", "rows_selected", "CASE WHEN n >= 20 THEN LEAST(50, n - seed) ELSE n END", "valid"),
    _metric("stages", "rows_final", "COUNT(*)", "final"),
    *[
        _metric("model", c, f"ROUND(arg_max({c}, iteration), 6)", _last)
        for c in ("accuracy", "f1", "n_labeled")
    ],
    *[
        _metric("strategies", c, c, "savings")
        for c in ("target_accuracy", "n_labeled_entropy", "n_labeled_random", "samples_saved",
                  "savings_pct")
    ],
]
oracle(
    "final_metrics", " UNION ALL ".join(_final), "dirty_reviews corrections history",
    f"{STAGES}, {SAVINGS}",
)
