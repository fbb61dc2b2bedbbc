"""Row predicates over text, labels and confidences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import CONFIDENCE, ERROR_LABEL, LABEL

LOW_CONFIDENCE = 0.7

# Words that mark a text dataset.
TEXT_KEYWORDS = (
    "text", "corpus", "nlp", "document", "language",
    "sentiment", "review", "tweet", "opinion", "classification",
)


def filter_text_datasets(
    catalog: DataFrame, keywords: Sequence[str] = TEXT_KEYWORDS
) -> DataFrame:
    """Records whose description or title mentions a keyword."""
    words = F.lower(
        F.concat(
            F.coalesce("description", F.lit("")), F.lit(" "), F.coalesce("title", F.lit(""))
        )
    )
    return catalog.where(reduce(or_, [words.contains(k) for k in keywords]))


def filter_low_confidence(
    df: DataFrame, threshold: float = LOW_CONFIDENCE, confidence: str = CONFIDENCE
) -> DataFrame:
    """Rows below the threshold; a missing confidence is neither low nor high."""
    return df.where(F.col(confidence) < F.lit(float(threshold)))


def valid_label(label: str = LABEL) -> Column:
    return F.col(label).isNotNull() & (F.col(label).cast("string") != ERROR_LABEL)


def no_error_label(label: str = LABEL) -> Column:
    return ~F.col(label).cast("string").eqNullSafe(ERROR_LABEL)


def filter_valid_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows with a label that is not the error label."""
    return df.where(valid_label(label))


def drop_error_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows without the error label; rows without a label stay."""
    return df.where(no_error_label(label))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every (listed) column."""
    return df.dropna(subset=list(subset) if subset else None)
