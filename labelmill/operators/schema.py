"""Column naming: aliases of the text and label columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labelmill.functions.columns import TEXT

ORIGINAL_LABEL = "original_label"

# Accepted names of the text and the label column.
TEXT_FALLBACKS = ("review", "sentence", "comment", "content", "tweet")
LABEL_FALLBACKS = ("sentiment", "label", "category", "class")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename the text and label columns to ``text`` and ``original_label``.

    Names match in any case. A target that exists already, in any case, only gets
    its plain spelling; of several candidates the first is renamed and the others stay.
    """
    renamed = {}
    for target, aliases in ((TEXT, TEXT_FALLBACKS), (ORIGINAL_LABEL, LABEL_FALLBACKS)):
        match = _named(df, (target,)) or next((c for c in df.columns if c.lower() in aliases), None)
        if match and match != target:
            renamed[match] = target
    return df.withColumnsRenamed(renamed)


def _named(df: DataFrame, names: tuple[str, ...]) -> str | None:
    """The column of the first name there is, in any case; an exact match goes first."""
    for name in names:
        same = [c for c in df.columns if c.lower() == name]
        if same:
            return name if name in same else same[0]
    return None


def resolve_text(df: DataFrame) -> str:
    """Name of the text column: ``text``, a known alias, or the first column."""
    return _named(df, (TEXT, *TEXT_FALLBACKS)) or df.columns[0]


def resolve_label(df: DataFrame) -> str | None:
    """Name of the human label column, if there is one."""
    return _named(df, (ORIGINAL_LABEL, "label", "sentiment"))
