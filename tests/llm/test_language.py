"""Language ID by held-out accuracy, and its mixtures by planted ones."""

import pytest
from pyspark.sql import functions as F

from labelmill.llm.language_id import fit, keep_languages, predict
from labelmill.llm.queries import op7_language_id


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_held_out_accuracy(spark, sf_dir, docs):
    found = op7_language_id(spark, sf_dir).join(docs, "doc_id").where("held_out")
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and right >= 0.99 * n


def test_held_out_documents_teach_nothing(spark, docs):
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    changed = docs.withColumn("lang", F.when(crc == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in fit(changed).languages


def test_a_mixture_gives_both_languages(spark, docs):
    model = fit(docs)
    longest = {r.lang: r.text for r in docs.where("n_chars between 1500 and 4000").groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    rows = [(1, longest["en"][:1200] + "\n" + longest["de"][:800]), (2, longest["fr"])]
    got = {r.doc_id: r for r in predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1].lang_pred == "en" and set(got[1].languages) == {"en", "de"} and 0.4 < got[1].score < 0.8
    assert got[2].languages == ["fr"]


def test_odd_rows(odd, nothing, docs):
    model = fit(docs)
    got = predict(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 4, 8, None}
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in got)
    assert predict(nothing, model).count() == 0


def test_nothing_to_learn_from(odd, nothing):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in predict(unlabelled, fit(unlabelled)).collect()} == {"und"}
    assert keep_languages(unlabelled).count() == odd.count()
    assert keep_languages(nothing).count() == 0


def test_kept_documents_keep_their_columns(odd, docs):
    kept = keep_languages(odd)
    assert kept.columns == odd.columns
    assert sorted(r[0] or 0 for r in kept.collect()) == [0, 1, 5, 6, 7, 7]
    assert keep_languages(docs, ["fr"]).where("lang <> 'fr'").count() <= 2
