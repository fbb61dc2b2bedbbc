"""Label replies: stripping of code fences and strict JSON reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import ERROR_LABEL

# Code points that count as white space around a reply.
WHITESPACE = "".join(
    chr(c)
    for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
FENCE = "`"
FENCE_NAME = "json"


def strip_fences(raw: Column) -> Column:
    """Reply without outer white space, back-ticks and leading letters of ``json``."""
    space = F.lit(WHITESPACE)
    text = F.trim(F.trim(raw, space), F.lit(FENCE))
    return F.trim(F.ltrim(text, F.lit(FENCE_NAME)), space)


def read_replies(df: DataFrame, raw: str, label: str, confidence: str) -> DataFrame:
    """Add label and confidence of a reply; anything unreadable is ('error', 0.0).

    The text is parsed as the only element of an array, because the variant
    parser would ignore what follows a complete value. Intermediate values are
    columns, so that each reply is parsed once.
    """
    others = [c for c in df.columns if c not in (label, confidence)]
    wrapped = F.concat(F.lit("["), strip_fences(F.col(raw)), F.lit("]"))
    parsed = df.select(*others, F.try_parse_json(wrapped).alias("_all"))
    only = parsed.select(
        *others,
        F.when(
            F.try_variant_get("_all", "$[1]", "variant").isNull(),
            F.try_variant_get("_all", "$[0]", "variant"),
        ).alias("_reply"),
    )
    read = only.select(
        *others,
        F.coalesce(F.schema_of_variant("_reply").startswith("OBJECT"), F.lit(False)).alias("_ok"),
        F.map_keys(F.try_variant_get("_reply", "$", "map<string, variant>")).alias("_keys"),
        F.try_variant_get("_reply", "$.label", "string").alias("_label"),
        F.try_variant_get("_reply", "$.confidence", "double").alias("_number"),
    )

    def has(key: str) -> Column:
        return F.coalesce(F.array_contains("_keys", key), F.lit(False))

    number = F.when(has("confidence"), F.col("_number")).otherwise(F.lit(0.0))
    checked = read.withColumn("_number", F.when(F.col("_ok"), number))
    good = F.col("_number").isNotNull()
    found = F.when(has("label"), F.col("_label")).otherwise(ERROR_LABEL)
    sure = F.nanvl("_number", F.lit(None).cast("double"))
    return checked.select(
        *others,
        F.when(good, found).otherwise(ERROR_LABEL).alias(label),
        F.when(good, sure).otherwise(F.lit(0.0)).alias(confidence),
    )
