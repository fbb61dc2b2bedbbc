"""The whole flow on stored replies and corrections."""

from pyspark.sql import functions as F

from labelmill.operators import annotate
from labelmill.plans.flow import curation_flow
from labelmill.plans.queries import view
from labelmill.sources import sinks


def test_flow(spark, sf_dir, tmp_path):
    raw = view(spark, sf_dir, "reviews").where("original_label IS NOT NULL")
    replies = raw.select(
        "row_id",
        F.when(F.col("row_id") % 9 == 0, "oops").otherwise(
            F.format_string('{"label": "%s", "confidence": %s}', "original_label",
                            ((F.col("row_id") % 10) / 10).cast("string"))
        ).alias("raw"),
    )
    labeler = annotate.stored_replies(replies)
    labels = raw.select(F.col("row_id").alias("row_index"), "text",
                        F.col("original_label").alias("label_auto"), F.lit(1.0).alias("confidence"))
    fixes = labels.where("row_index % 18 = 0")
    done = curation_flow(
        raw.withColumnRenamed("text", "Review"), labeler, fixes,
        n_select=15, n_iterations=2, tol=1e-3, max_features=200,
    )
    metrics = {(r["step"], r["metric"], r["text"]): r["value"] for r in done.metrics.collect()}
    n = raw.count()
    cleaned = done.stages.clean
    assert metrics["collect", "rows", None] == n
    assert metrics["clean", "rows_after", None] == cleaned.count() <= n
    assert done.queue.count() == metrics["annotate", "low_confidence", None]
    kept = cleaned.select("row_id")
    errors = kept.where("row_id % 9 = 0").count()
    assert metrics["annotate", "errors", None] == errors
    valid = kept.count() - kept.where("row_id % 9 = 0 AND row_id % 18 <> 0").count()
    assert metrics["al_select", "seed", None] == int(0.6 * valid)
    assert done.selected.count() == int(0.6 * valid) + 15
    assert metrics["al_select", "total", None] == done.selected.count()
    assert done.dataset.where("label_auto = 'error'").count() == 0
    card = {(r["metric"], r["text"]): r["value"] for r in done.card.collect()}
    assert card["final", None] == done.dataset.count()
    report = {(r["step"], r["metric"]): r["value"] for r in done.report.collect()}
    assert 0 < report["model", "accuracy"] <= 1
    assert done.quality.where("section = 'strategy'").count() == 3
    assert done.annotated.tasks.count() == kept.count()
    path = str(tmp_path / "metrics")
    sinks.write_metrics(done.metrics, path)
    assert spark.read.json(path).count() == done.metrics.count()


def test_flow_without_reviews(spark, sf_dir):
    raw = view(spark, sf_dir, "reviews").where("original_label IS NOT NULL")
    replies = raw.select("row_id", F.format_string(
        '{"label": "%s", "confidence": 0.9}', "original_label").alias("raw"))
    done = curation_flow(
        raw, annotate.stored_replies(replies), n_label=150, n_iterations=1, tol=1e-3,
        max_features=100,
    )
    assert done.queue.count() == 0
    actions = {r["step"]: r["text"] for r in done.metrics.where("metric = 'action'").collect()}
    assert actions == {"clean_review": "skipped", "review": "auto_skipped", "al_review": "skipped"}
    assert done.stages.labeled.count() == 150


def test_the_input_is_read_once(spark, sf_dir):
    """The joins and texts of the input are gone through once, however many steps read it."""
    met = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            met.add(len(frame))
            yield frame

    raw = view(spark, sf_dir, "reviews").where("original_label IS NOT NULL").limit(120).localCheckpoint()
    replies = raw.select("row_id", F.format_string(
        '{"label": "%s", "confidence": 0.9}', "original_label").alias("raw"))
    done = curation_flow(
        raw.mapInPandas(counted, raw.schema), annotate.stored_replies(replies), n_iterations=1, tol=1e-3, max_features=50,
    )
    assert done.report.count() > 0 and done.quality.count() > 0 and done.card.count() > 0
    assert met.value == 120
