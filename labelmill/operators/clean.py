"""Cleaning: missing values, then duplicates, then outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import (
    ROW_ID,
    content_columns,
    nan_to_null,
    numeric_columns,
    row_digest,
    small_table,
)
from labelmill.functions.ranks import quantiles
from labelmill.operators.profile import IQR_FACTOR, bounds_of
from labelmill.storage import stage

# Names of the steps.
DEFAULT_STRATEGY = {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr"}


def _fill_scalars(df: DataFrame, cols: Sequence[str], how: str, **method) -> dict:
    if not cols:
        return {}
    if how == "mean":
        return df.agg(*[F.avg(F.col(c)).alias(c) for c in cols]).first().asDict()
    if how == "median":
        return {c: v[0] for c, v in quantiles(df, cols, [0.5], **method).items()}
    raise ValueError(f"unknown fill: {how!r}")


def column_fill_values(
    df: DataFrame, cols: Sequence[str] | None = None, how: str = "median", **method
) -> DataFrame:
    """Median or mean of each numeric column, missing values (NaN too) left out."""
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    rows = list(_fill_scalars(df, cols, how, **method).items())
    return small_table(df.sparkSession, rows, "column string, fill double")


def _impute(df: DataFrame, cols: Sequence[str] | None, how: str, **method) -> DataFrame:
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    fills = _fill_scalars(df, cols, how, **method)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in fills.items()}
    ) if fills else df


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, **method) -> DataFrame:
    return _impute(df, cols, "median", **method)


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _impute(df, cols, "mean")


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any (listed) column."""
    return nan_to_null(df).dropna(subset=list(cols or df.columns))


def drop_duplicates(
    df: DataFrame, cols: Sequence[str] | None = None, id_col: str = ROW_ID
) -> DataFrame:
    """One row per distinct content, the one with the lowest id.

    Copies meet in the map-side combine first, so a content that holds a third of the
    rows reaches the reducer once per map task. With further columns, the lowest ids
    are found first and their rows picked by id.
    """
    cols = list(cols or content_columns(df, id_col))
    kept = df.groupBy(*cols).agg(F.min(id_col).alias(id_col))
    if set(df.columns) > {*cols, id_col}:
        return df.join(kept.select(id_col), id_col, "left_semi").select(*df.columns)
    return kept.select(*df.columns)


def _clip(col: Column, bounds: tuple | None) -> Column:
    value = col.cast("double")
    if bounds is None:
        return value
    clipped = F.least(F.greatest(value, F.lit(bounds[2])), F.lit(bounds[3]))
    return F.when(value.isNotNull(), clipped)


def clip_iqr(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    k: float = IQR_FACTOR,
    numbers: DataFrame | None = None,
    **how,
) -> DataFrame:
    """Winsorise to the fences. ``numbers`` may give the same numeric rows more cheaply."""
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    bounds = bounds_of(df if numbers is None else numbers, cols, k, **how)
    return df.withColumns({c: _clip(F.col(c), bounds[c]) for c in cols}) if cols else df


def remove_outliers(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    k: float = IQR_FACTOR,
    numbers: DataFrame | None = None,
    **how,
) -> DataFrame:
    """Drop rows outside the fences, column by column in the given order.

    Each column's fences are taken from the rows the earlier columns left. They are
    found over the numbers alone, which are written once; the rows themselves are
    then filtered by all fences in one scan.
    """
    cols = list(cols or numeric_columns(df, [ROW_ID]))
    if not cols:
        return df
    numbers = stage((df if numbers is None else numbers).select(*cols), "numbers")
    kept = F.lit(True)
    for c in cols:
        bounds = bounds_of(numbers, [c], k, **how)[c]
        inside = F.lit(False) if bounds is None else F.col(c).between(bounds[2], bounds[3])
        kept, numbers = kept & inside, numbers.where(inside)
    return df.where(kept)


def clean(
    df: DataFrame,
    strategy: Mapping[str, str] | None = None,
    cols: Sequence[str] | None = None,
    id_col: str = ROW_ID,
    **how,
) -> DataFrame:
    """Apply a cleaning strategy; a value that names no step leaves the table as it is.

    Fences after a dedup are computed over (digest, numbers) rows, so the text
    is shuffled once, by the dedup itself.
    """
    strategy = DEFAULT_STRATEGY if strategy is None else strategy
    df = nan_to_null(df)
    numeric = list(cols or numeric_columns(df, [id_col]))
    missing = strategy.get("missing", "median")
    if missing in ("median", "mean"):
        df = _impute(df, numeric, missing, **(how if missing == "median" else {}))
    elif missing == "drop":
        df = df.dropna()
    numbers = df.select(*numeric)
    if strategy.get("duplicates") == "drop":
        digest = row_digest(df, content_columns(df, id_col))
        # digests of whole rows are costly and the numbers are read more than once
        if numeric and strategy.get("outliers", "clip_iqr") in ("clip_iqr", "remove"):
            numbers = stage(df.select(digest.alias("_digest"), *numeric).distinct().drop("_digest"), "numbers")
        df = drop_duplicates(df, id_col=id_col)
    outliers = strategy.get("outliers", "clip_iqr")
    if not numeric:
        return df
    if outliers == "clip_iqr":
        return clip_iqr(df, numeric, numbers=numbers, **how)
    if outliers == "remove":
        return remove_outliers(df, numeric, numbers=numbers, **how)
    return df
