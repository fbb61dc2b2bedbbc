"""Column helpers: types, missing values, row digests, seeded keys."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ID = "row_id"
TEXT = "text"
LABEL = "label_auto"
CONFIDENCE = "confidence"
ERROR_LABEL = "error"

# How a missing value reads once it is turned into text.
MISSING_AS_TEXT = "nan"

# Rows of short columns a join side may have to be broadcast.
BROADCAST_ROWS = 200_000

# JSON formats that keep every digit of a time.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Hex digits of the md5 key: 15 fit a non-negative bigint, 13 fit a double exactly.
KEY_DIGITS = 15
UNIFORM_DIGITS = 13


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def content_columns(df: DataFrame, id_col: str = ROW_ID) -> list[str]:
    return [c for c in df.columns if c != id_col]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers arrive as NaN or null; keep null only."""
    floats = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def one_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fold -0.0 into 0.0, so that a value and a stored statistic of it compare alike."""
    floats = {
        c: F.col(c) + F.lit(0.0)
        for c in cols
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lookup(values: Sequence[float]) -> Column:
    """Constant array of doubles, folded to a literal once."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def as_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(MISSING_AS_TEXT))


def truncate_text(col: Column, n: int) -> Column:
    """First ``n`` characters of the value as text."""
    return F.substring(as_text(col), 1, n)


def row_digest(df: DataFrame, cols: Sequence[str]) -> Column:
    """256-bit digest of the listed columns; nulls are equal, null differs from ''.

    A null field is absent from the JSON text. Adding 0.0 folds -0.0 into 0.0; times
    keep their microseconds and offset, binary values are written out whole.
    """
    fields = []
    for name in cols:
        col = F.col(name)
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            col = col + F.lit(0.0)
        fields.append(col.alias(name))
    return F.unhex(F.sha2(F.to_json(F.struct(*fields), EXACT_TIMES), 256))


def _md5_hex(id_col: str, seed: str, digits: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def seeded_key(id_col: str, seed: int | str) -> Column:
    """Repeatable pseudo-random sort key of a row; ties are broken by the id."""
    return _md5_hex(id_col, str(seed), KEY_DIGITS)


def seeded_uniform(id_col: str, seed: int | str) -> Column:
    """Repeatable pseudo-random number in [0, 1)."""
    return _md5_hex(id_col, str(seed), UNIFORM_DIGITS) / F.lit(float(16**UNIFORM_DIGITS))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a short table of short rows; leave the join of a longer one to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few driver-side scalars as a table."""
    return spark.createDataFrame([tuple(r) for r in rows], schema).coalesce(1)
