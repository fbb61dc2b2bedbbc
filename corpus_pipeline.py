"""The training-data pipeline: language ID, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm.decontaminate import drop_contaminated
from labelmill.llm.language_id import keep_languages
from labelmill.llm.line_dedup import drop_repeated_chunks
from labelmill.llm.near_dedup import drop_near_copies
from labelmill.llm.packing import pack
from labelmill.storage import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go."""
    return keep_languages(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Multi-line chunks that occurred before go; every document stays."""
    return drop_repeated_chunks(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence, as op2_packing returns them."""
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("lines", lines), ("near", near), ("decontaminate", decontaminate), ("packing", packing)]
#: Packing and language ID have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each read from the written table of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
