"""Registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm.bpe import encode
from labelmill.llm.decontaminate import contamination
from labelmill.llm.html_text import page_text
from labelmill.llm.language_id import fit, predict
from labelmill.llm.line_dedup import drop_repeated_chunks
from labelmill.llm.near_dedup import near_duplicates
from labelmill.llm.packing import pack
from labelmill.llm.quality import BASE, judge, ledger, mask
from labelmill.llm.ranked_search import ranked_search
from labelmill.llm.secret_scan import scan_secrets, span_list
from labelmill.llm.suffix_dedup import drop_repeats, removed_bytes
from labelmill.llm.unit_dedup import PASSAGE_WORDS, drop_repeated_units
from labelmill.llm.whitening import whiten


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"), "n_layers", "n_cut")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = pack(read(spark, sf_dir, "documents"), tokenizer, ranks)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_units(read(spark, sf_dir, "documents"), unit="passage", min_words=PASSAGE_WORDS)
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"])), ",")
    return found.select("doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), spans.alias("removed"), "text")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", removed_bytes(F.col("spans")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("ranges") > 0).alias("contaminated"),
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = judge(ledger(read(spark, sf_dir, "documents")), "v2")
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_chunks(read(spark, sf_dir, "documents").select("doc_id", "text"), details=True)
    lines = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["first"], r["last"])), ",")
    return found.select("doc_id", F.col("n_lines").cast("long"), F.coalesce(lines, F.lit(0)).alias("n_removed"), F.coalesce(spans, F.lit("")).alias("removed"), "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text(read(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decoding=True)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation beyond a long is null here; the operator has all its digits
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_near_dedup": op6_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_bpe": op11_bpe,
    "op12_whitening": op12_whitening,
    "op13_ranked_search": op13_ranked_search,
}
