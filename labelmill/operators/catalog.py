"""Catalogue of candidate datasets from search hits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.replies import WHITESPACE
from labelmill.operators.filters import filter_text_datasets
from labelmill.operators.order import top_k_per_group

CATALOG_COLUMNS = ("source", "title", "description", "url", "ref", "size_mb")
HITS_PER_QUERY = 5
CATALOG_ROWS = 50
MAX_CATALOG = 1_000
# Words of a preferred title.
PREFERRED_TITLE = "sentiment|review|imdb"
# Line breaks of a reply and the marks around a listed query.
LINE_BREAK = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
LIST_MARKS = "- "
TRANSLATION = "Put this wish for a dataset into English and answer with nothing else.\n"
SEARCH = (
    "Write {n} different queries that would find training datasets for the wish below, "
    "each on its own line without marks or numbers.\n"
)

# Page address of a dataset by source.
URL_PREFIXES = {
    "Kaggle": "https://www.kaggle.com/datasets/",
    "HuggingFace": "https://huggingface.co/datasets/",
}


def build_translation_prompts(df: DataFrame, wish: str = "wish") -> DataFrame:
    """One request per row to put a search wish into English."""
    others = [c for c in df.columns if c != wish]
    return df.select(*others, F.concat(F.lit(TRANSLATION), wish).alias("prompt"))


def build_search_prompts(df: DataFrame, wish: str = "wish", n: int = 6) -> DataFrame:
    """One request per row for ``n`` search queries; ``split_queries`` reads the reply."""
    others = [c for c in df.columns if c != wish]
    return df.select(*others, F.concat(F.lit(SEARCH.format(n=n)), wish).alias("prompt"))


def split_queries(df: DataFrame, reply: str = "reply") -> DataFrame:
    """One search query per non-blank line of a reply, without list marks.

    A line of dashes alone gives an empty query.
    """
    others = [c for c in df.columns if c != reply]
    space = F.lit(WHITESPACE)
    lines = df.select(*others, F.posexplode(F.split(reply, LINE_BREAK)).alias("line", "query"))
    return lines.where(F.trim("query", space) != "").withColumn(
        "query", F.trim(F.trim("query", F.lit(LIST_MARKS)), space)
    )


def catalog_records(hits: DataFrame, prefixes: Mapping[str, str] = URL_PREFIXES) -> DataFrame:
    """Raw hits as records: address from the ref, empty text for a missing description."""
    prefix: Column = F.lit("")
    for source, address in prefixes.items():
        prefix = F.when(F.col("source") == source, address).otherwise(prefix)
    return hits.withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "url": F.concat(prefix, "ref"),
            "size_mb": F.lit(""),
        }
    )


def dedup_by_key(df: DataFrame, key: str = "url", order: str = "pos") -> DataFrame:
    """The first record of each key; at most one per key and map task is shuffled."""
    return top_k_per_group(df, [key], [order], 1)


def limit_catalog(catalog: DataFrame, n: int = CATALOG_ROWS, order: str = "pos") -> DataFrame:
    """The first ``n`` records in search order, ``order`` being unique; a short list by purpose."""
    if n > MAX_CATALOG:
        raise ValueError(f"a catalogue lists at most {MAX_CATALOG} records")
    return catalog.orderBy(order).limit(n)


def pick_preferred(
    catalog: DataFrame,
    source: str = "HuggingFace",
    pattern: str = PREFERRED_TITLE,
    order: str = "pos",
) -> DataFrame:
    """The first record of a source whose title matches, else its first record."""
    matches = F.coalesce(F.col("title").rlike(f"(?i){pattern}"), F.lit(False))
    return catalog.where(F.col("source") == source).orderBy(~matches, order).limit(1)


def build_catalog(
    hits: DataFrame,
    prefixes: Mapping[str, str] = URL_PREFIXES,
    per_query: int = HITS_PER_QUERY,
    n: int = CATALOG_ROWS,
) -> DataFrame:
    """Hits (query_id, source, pos, …) to the catalogue, in search order."""
    top = top_k_per_group(hits, ["query_id", "source"], ["pos"], per_query)
    unique = dedup_by_key(catalog_records(top, prefixes))
    return limit_catalog(filter_text_datasets(unique), n).select("pos", *CATALOG_COLUMNS)
