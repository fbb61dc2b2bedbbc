"""Review queues out, corrected rows in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import CONFIDENCE, LABEL, ROW_ID, TEXT
from labelmill.operators.filters import LOW_CONFIDENCE

QUEUE_COLUMNS = (TEXT, LABEL, CONFIDENCE)
ROW_INDEX = "row_index"


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raise if a key occurs twice, since a join would then multiply rows."""
    repeated = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} {repeated[0][key]} occurs more than once in the {what}")


def review_queue(
    df: DataFrame, id_col: str = ROW_ID, cols: Sequence[str] = QUEUE_COLUMNS
) -> DataFrame:
    """The columns a reviewer sees, keyed by ``row_index``."""
    return df.select(F.col(id_col).alias(ROW_INDEX), *[c for c in cols if c in df.columns])


def take_rows(pool: DataFrame, ids: DataFrame, id_col: str = ROW_ID) -> DataFrame:
    """Pool rows with a listed id."""
    return pool.join(ids.select(id_col), id_col, "left_semi")


def remove_rows(pool: DataFrame, ids: DataFrame, id_col: str = ROW_ID) -> DataFrame:
    """Pool rows without a listed id."""
    return pool.join(ids.select(id_col), id_col, "left_anti")


def _upsert(df: DataFrame, corrections: DataFrame, id_col: str) -> DataFrame:
    changed = [c for c in corrections.columns if c != ROW_INDEX and c in df.columns]
    new = corrections.select(
        F.col(ROW_INDEX).alias(id_col), F.lit(True).alias("_corrected"),
        *[F.col(c).alias(f"_new_{c}") for c in changed],
    )
    value = {c: F.when(F.col("_corrected"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in changed}
    merged = df.join(new, id_col, "left")
    return merged.select(*[value[c].alias(c) if c in value else c for c in df.columns])


def apply_corrections(
    df: DataFrame,
    corrections: DataFrame,
    threshold: float = LOW_CONFIDENCE,
    mode: str = "upsert",
    id_col: str = ROW_ID,
) -> DataFrame:
    """Merge a corrected queue.

    ``upsert`` (default) changes the corrected rows and keeps every other row.
    ``replace`` keeps only rows at or above the threshold and appends the
    corrected ones, which carry the queue's columns alone. A row corrected twice is
    an error.
    """
    require_unique(corrections, ROW_INDEX, "corrections")
    if mode == "upsert":
        return _upsert(df, corrections, id_col)
    if mode != "replace":
        raise ValueError(f"unknown mode: {mode!r}")
    sure = df.where(F.col(CONFIDENCE) >= F.lit(float(threshold)))
    new = corrections.withColumnRenamed(ROW_INDEX, id_col)
    return sure.unionByName(new, allowMissingColumns=True)


def replace_with_reviewed(
    df: DataFrame, corrections: DataFrame, mode: str = "replace", id_col: str = ROW_ID
) -> DataFrame:
    """The reviewed rows in place of the table, or merged into it (``upsert``); each once."""
    require_unique(corrections, ROW_INDEX, "corrections")
    if mode == "upsert":
        return _upsert(df, corrections, id_col)
    return corrections.withColumnRenamed(ROW_INDEX, id_col)
