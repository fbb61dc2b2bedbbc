"""Data-quality profile: missing cells, duplicates, outliers, imbalance, shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.functions.columns import (
    ROW_ID,
    content_columns,
    nan_to_null,
    numeric_columns,
    row_digest,
    small_side,
    small_table,
    string_columns,
)
from labelmill.functions.ranks import commonest, quantiles
from labelmill.storage import stage

IQR_FACTOR = 1.5
IMBALANCE_LIMIT = 0.8
BAR_PIXELS = 220  # width of the largest bar of a category chart
START_CHARS = 32  # leading characters that order candidate values
EXPLAIN = "Say in a few sentences why the cleaning steps below suit this table.\nFindings: "
EXPLAIN_STEPS = "\nSteps: "
CANDIDATES = 5_000  # digests of candidate values that may be broadcast


def _long(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn the single row of an aggregate into one output row per entry."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null cells per column with at least one, and their share of the rows in %."""
    cols = list(cols or content_columns(df))
    totals = nan_to_null(df).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)],
    )
    rows = [
        [F.lit(c), F.col(f"m{i}"), F.round(F.try_divide(F.col(f"m{i}") * F.lit(100.0), F.col("rows")), 1)]
        for i, c in enumerate(cols)
    ]
    return _long(totals, rows, ["column", "missing", "pct"]).where("missing > 0")


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct content. Only digests are shuffled."""
    df = nan_to_null(df)
    cols = list(cols or content_columns(df))
    groups = df.select(row_digest(df, cols).alias("digest")).groupBy("digest").count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def bounds_of(
    df: DataFrame, cols: Sequence[str], k: float = IQR_FACTOR, **how
) -> dict[str, tuple[float, float, float, float] | None]:
    """(q1, q3, lower, upper) per column as driver scalars; None for an empty column."""
    result = {}
    for col, (q1, q3) in quantiles(df, cols, [0.25, 0.75], **how).items():
        iqr = None if q1 is None else q3 - q1
        result[col] = None if q1 is None else (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return result


def iqr_bounds(
    df: DataFrame, cols: Sequence[str] | None = None, k: float = IQR_FACTOR, **how
) -> DataFrame:
    """Quartiles and fences of each numeric column."""
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    rows = [
        (c, b[0], b[1], b[1] - b[0], b[2], b[3]) if b else (c, None, None, None, None, None)
        for c, b in bounds_of(df, cols, k, **how).items()
    ]
    schema = "column string, q1 double, q3 double, iqr double, lower double, upper double"
    return small_table(df.sparkSession, rows, schema)


def outside(col: Column, bounds: tuple | None) -> Column:
    if bounds is None:
        return F.lit(False)
    return (col < F.lit(bounds[2])) | (col > F.lit(bounds[3]))


def outlier_counts(
    df: DataFrame, cols: Sequence[str] | None = None, k: float = IQR_FACTOR, **how
) -> DataFrame:
    """Values outside the fences, per column with at least one."""
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    if not cols:
        return small_table(df.sparkSession, [], "column string, outliers bigint")
    df = nan_to_null(df)
    bounds = bounds_of(df, cols, k, **how)
    totals = df.agg(
        *[F.count_if(outside(F.col(c), bounds[c])).alias(f"o{i}") for i, c in enumerate(cols)]
    )
    rows = [[F.lit(c), F.col(f"o{i}")] for i, c in enumerate(cols)]
    return _long(totals, rows, ["column", "outliers"]).where("outliers > 0")


def table_shape(df: DataFrame, cols: Sequence[str] | None = None, **how) -> DataFrame:
    """Rows, columns, missing cells and outlying values of the table."""
    df = nan_to_null(df)
    cols = list(cols or content_columns(df))
    numeric = [c for c in numeric_columns(df) if c in cols]
    bounds = bounds_of(df, numeric, **how)

    def total(flags: list[Column]) -> Column:
        cells = F.lit(0)
        for flag in flags:
            cells = cells + flag.cast("int")
        return F.coalesce(F.sum(cells), F.lit(0)).cast("bigint")

    flags = [F.coalesce(outside(F.col(c), bounds[c]), F.lit(False)) for c in numeric]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(cols)).cast("bigint").alias("cols"),
        total([F.col(c).isNull() for c in cols]).alias("missing_cells"),
        total(flags).alias("outlier_cells"),
    )


def _cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Present string cells as (column, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def class_imbalance(
    df: DataFrame, cols: Sequence[str] | None = None, limit: float = IMBALANCE_LIMIT
) -> DataFrame:
    """All value shares of string columns whose commonest value exceeds ``limit``.

    A first pass over 8-byte hashes finds the columns that may qualify (a hash
    collision can only add a column, and the exact share is tested again), so
    long texts are grouped only where one value dominates them.
    """
    cols = list(cols or string_columns(df, [ROW_ID]))
    pairs = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("hash")) for c in cols]
    hashed = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("hash").isNotNull())
        .groupBy("column", "hash")
        .count()
        .groupBy("column")
        .agg((F.max("count") / F.sum("count")).alias("top_share"))
        .where(F.col("top_share") > F.lit(float(limit)))
    )
    dominated = [r["column"] for r in hashed.select("column").collect()]
    if not dominated:
        return small_table(df.sparkSession, [], "column string, value string, share double")
    counts = _cells(df, dominated).groupBy("column", "value").count()
    totals = counts.groupBy("column").agg(
        F.sum("count").alias("total"), F.max("count").alias("top")
    )
    share = F.col("count") / F.col("total")
    return (
        counts.join(F.broadcast(totals), "column")  # one row per column of the table
        .where(F.col("top") / F.col("total") > F.lit(float(limit)))
        .select("column", "value", F.round(share, 3).alias("share"))
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each present value."""
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = df.agg(F.count(F.col(col))).scalar()
    return counts.select("value", "n", (F.col("n") / total).alias("share"))


def _common_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` commonest values of a column, ties to the smaller value.

    Values are counted by digest, start and digest text, so a column of long texts
    costs one shuffle of short keys. The cut is found by rank selection; values that
    share the last count and start are candidates together. Only the candidates' full
    values are fetched, one per digest, and ranked.
    """
    value = F.col(col)
    digest = F.sha2(value, 256)
    cells = df.where(value.isNotNull())
    keyed = cells.select(F.concat(F.substring(value, 1, START_CHARS), F.lit("\u0000"), digest).alias("key"))
    counts = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "values")
    first = commonest(counts, "n", "key", k)
    cut = first.agg(F.min("n").alias("n")).first()["n"]
    if cut is None:
        return small_table(df.sparkSession, [], "value string, n bigint")
    # a start shared beyond the cut leaves the order to the rest of the value
    end = first.where(F.col("n") == cut).agg(F.max("key")).first()[0].split("\u0000")[0]
    start = F.substring_index("key", "\u0000", 1)
    near = counts.where((F.col("n") > cut) | ((F.col("n") == cut) & (start <= F.lit(end))))
    near = near.select(F.substring_index("key", "\u0000", -1).alias("digest"), "n")
    full = cells.select(value.alias("value"), digest.alias("digest")).join(small_side(near, CANDIDATES), "digest")
    found = full.groupBy("digest").agg(F.min("value").alias("value"), F.min("n").alias("n"))
    return found.select("value", "n").orderBy(F.desc("n"), "value").limit(k)


def top_categories(df: DataFrame, cols: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """The ``k`` commonest values of the first two string columns, with bar widths."""
    cols = list(cols or string_columns(df, [ROW_ID])[:2])
    if not cols:
        return small_table(
            df.sparkSession, [], "column string, value string, n bigint, position int, bar int"
        )
    top = _stack([_common_values(df, c, k).withColumn("column", F.lit(c)) for c in cols])
    # At most k rows per column from here on.
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    largest = F.max("n").over(Window.partitionBy("column"))
    return top.select(
        "column",
        "value",
        "n",
        F.row_number().over(order).alias("position"),
        F.floor(F.col("n") * BAR_PIXELS / largest).cast("int").alias("bar"),
    )


def content_totals(
    df: DataFrame, cols: Sequence[str], flags: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row: rows, duplicates, and the sum of each flag over the rows.

    One scan and one shuffle of digests: rows of equal content have equal flags,
    so a flag is summed as its value times the size of the group.
    """
    flags = flags or {}
    groups = (
        nan_to_null(df).select(row_digest(df, cols).alias("digest"),
                  *[f.cast("int").alias(name) for name, f in flags.items()])
        .groupBy("digest", *flags)
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def add_up(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return groups.agg(
        add_up(F.col("n")).alias("rows"),
        add_up(F.col("n") - 1).alias("duplicates"),
        *[add_up(F.col("n") * F.col(name)).alias(name) for name in flags],
    )


def _add(cols: Sequence[Column]) -> Column:
    total = F.lit(0)
    for col in cols:
        total = total + col
    return total


def _missing_flags(cols: Sequence[str]) -> dict[str, Column]:
    return {f"m{i}": F.col(c).isNull() for i, c in enumerate(cols)}


def _compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """The figures of two tables from their totals, side by side."""

    def figures(totals: DataFrame, name: str) -> DataFrame:
        missing = _add([F.col(c) for c in totals.columns if c.startswith("m")])
        rows = [
            [F.lit("Rows"), F.col("rows")],
            [F.lit("Missing values"), missing],
            [F.lit("Duplicate rows"), F.col("duplicates")],
        ]
        return _long(totals, rows, ["metric", name])

    better = F.when(F.col("after") <= F.col("before"), "better").otherwise("worse")
    both = figures(before, "before").join(F.broadcast(figures(after, "after")), "metric")
    return both.select("metric", "before", "after", better.alias("verdict"))  # three rows


def compare_tables(
    before: DataFrame, after: DataFrame, cols: Sequence[str] | None = None, id_col: str = ROW_ID
) -> DataFrame:
    """Rows, missing cells and duplicate rows before and after; ``better`` if not more."""
    left = list(cols or content_columns(before, id_col))
    right = list(cols or content_columns(after, id_col))
    return _compare(
        content_totals(before, left, _missing_flags(left)),
        content_totals(after, right, _missing_flags(right)),
    )


def _entries(
    df: DataFrame,
    section: str,
    key: Column,
    entries: Sequence[tuple[Column | str, Column | None, Column | None]],
) -> DataFrame:
    """One report row per input row and (metric, value, text) entry."""
    rows = []
    for metric, value, text in entries:
        name = F.lit(metric) if isinstance(metric, str) else metric
        rows.append(
            F.struct(
                F.lit(section).alias("section"),
                key.cast("string").alias("key"),
                name.cast("string").alias("metric"),
                (F.lit(None) if value is None else value).cast("double").alias("value"),
                (F.lit(None) if text is None else text).cast("string").alias("text"),
            )
        )
    return df.select(F.inline(F.array(*rows)))


def _issue_totals(df: DataFrame, cols: Sequence[str], numeric: Sequence[str], **how) -> DataFrame:
    """Totals with one flag per column for missing (m…) and one for outlying (o…) values."""
    df = nan_to_null(df)
    bounds = bounds_of(df, numeric, **how)
    outlying = {
        f"o{i}": F.coalesce(outside(F.col(c), bounds[c]), F.lit(False))
        for i, c in enumerate(numeric)
    }
    return content_totals(df, cols, {**_missing_flags(cols), **outlying})


def detect_issues(df: DataFrame, id_col: str = ROW_ID, **how) -> DataFrame:
    """The profile of one table as long rows (section, key, metric, value, text).

    Shape, duplicates, missing cells and outliers come from one scan.
    """
    cols, numeric = content_columns(df, id_col), numeric_columns(df, [id_col])
    return _issues(df, id_col, _issue_totals(df, cols, numeric, **how))


def _issues(df: DataFrame, id_col: str, totals: DataFrame) -> DataFrame:
    cols, numeric = content_columns(df, id_col), numeric_columns(df, [id_col])
    strings = string_columns(df, [id_col])
    missing = [f"m{i}" for i in range(len(cols))]
    outlying = [f"o{i}" for i in range(len(numeric))]
    entries = [
        ("shape", "table", "rows", F.col("rows"), F.lit(True)),
        ("shape", "table", "cols", F.lit(len(cols)), F.lit(True)),
        ("shape", "table", "missing_cells", _add([F.col(m) for m in missing]), F.lit(True)),
        ("shape", "table", "outlier_cells", _add([F.col(o) for o in outlying]), F.lit(True)),
        ("shape", "table", "duplicates", F.col("duplicates"), F.lit(True)),
    ]
    for name, c in zip(missing, cols):
        pct = F.round(F.try_divide(F.col(name) * F.lit(100.0), F.col("rows")), 1)
        entries.append(("missing", c, "count", F.col(name), F.col(name) > 0))
        entries.append(("missing", c, "pct", pct, F.col(name) > 0))
    for name, c in zip(outlying, numeric):
        entries.append(("outliers", c, "count", F.col(name), F.col(name) > 0))
    rows = [
        [F.lit(section), F.lit(key), F.lit(metric), value.cast("double"),
         F.lit(None).cast("string"), shown]
        for section, key, metric, value, shown in entries
    ]
    found = _long(totals, rows, ["section", "key", "metric", "value", "text", "shown"])
    imbalance = _entries(
        class_imbalance(df, strings), "imbalance", F.col("column"),
        [("share", F.col("share"), F.col("value"))],
    )
    return _stack([found.where("shown").drop("shown"), imbalance])


def build_strategy_prompt(issues: DataFrame, strategy: Mapping[str, str]) -> DataFrame:
    """One request to explain a cleaning strategy: the long rows of ``detect_issues`` and the steps as JSON.

    A profile has a few rows per column of the table.
    """
    rows = F.array_sort(F.collect_list(F.struct("section", "key", "metric", "value", "text")))
    steps = F.create_map(*[F.lit(x) for pair in sorted(strategy.items()) for x in pair])
    return issues.agg(rows.alias("rows")).select(
        F.concat(F.lit(EXPLAIN), F.to_json("rows"), F.lit(EXPLAIN_STEPS), F.to_json(steps)).alias("prompt")
    )


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def quality_report(
    before: DataFrame,
    after: DataFrame,
    strategy: dict[str, str],
    id_col: str = ROW_ID,
    sample_rows: int = 5,
    **how,
) -> DataFrame:
    """Profile, strategy, before/after comparison, categories and sample rows."""
    spark = before.sparkSession
    chosen = small_table(spark, sorted(strategy.items()), "step string, choice string")
    cols, numeric = content_columns(before, id_col), numeric_columns(before, [id_col])
    kept = content_columns(after, id_col)
    # One table of totals serves the profile and the comparison.
    totals = _issue_totals(before, cols, numeric, **how)
    compared = _compare(totals, content_totals(after, kept, _missing_flags(kept)))
    top = top_categories(before, string_columns(before, [id_col])[:2])
    numbers = numeric_columns(after)
    cells = [(c, F.col(c), None) if c in numbers else (c, None, F.col(c)) for c in kept]
    return _stack(
        [
            _issues(before, id_col, totals),
            _entries(chosen, "strategy", F.col("step"), [("choice", None, F.col("choice"))]),
            _entries(
                compared, "compare", F.col("metric"),
                [("before", F.col("before"), None), ("after", F.col("after"), F.col("verdict"))],
            ),
            _entries(
                top, "categories", F.col("column"),
                [(F.col("position"), F.col("n"), F.col("value"))],
            ),
            _entries(
                after.orderBy(id_col).limit(sample_rows), "sample", F.col(id_col), cells
            ),
        ]
    )
