"""Replies, prompts, tasks, review queues."""

import json
import time

import pytest
from pyspark.sql import functions as F

from labelmill.operators import annotate, filters, review
from labelmill.plans.queries import view
from labelmill.sources import sinks, tables

REPLIES = [
    "not json",
    '```json\n{"label": "positive", "confidence": 0.95}\n```',
    '{"confidence": 0.4}',
    '{"label": "neutral"}',
    '{"label": "n", "confidence": "0.8"}',
    '{"label": "n", "confidence": "high"}',
    '{"label": null, "confidence": 0.5}',
    "[1]",
    '{"label": "p", "confidence": 0.9} trailing',
    '{"label": "n", "confidence": null}',
    "",
    '  {"label":"x","confidence":1}  ',
    '{"label":"x","confidence":true}',
    "{}",
    '{"label":"a","confidence":[1]}',
    '{"a":1},{"b":2}',
    "{'label':'a'}",
    "null",
    '"s"',
    "5",
    '{"label":"a","confidence":" 0.5 "}',
    '{"label":"a","confidence":12345678901234567890}',
    '`{"label":"q","confidence":0.2}`',
    '\xa0{"label":"q","confidence":0.2} ',
    '{"label":"a","confidence":"1e2"}',
    '{"label":"a\\u0041","confidence":0.3}',
    '{"label": "a", "confidence": 0.5, "more": {"label": "b"}}',
    '{"Label": "a", "CONFIDENCE": 0.5}',
]


ERROR = ("error", 0.0)
# What each reply above says, in the same order.
READ = [
    ERROR, ("positive", 0.95), ("error", 0.4), ("neutral", 0.0), ("n", 0.8), ERROR, (None, 0.5), ERROR,
    ERROR, ERROR, ERROR, ("x", 1.0), ("x", 1.0), ERROR, ERROR, ERROR, ERROR, ERROR, ERROR, ERROR,
    ("a", 0.5), ("a", 12345678901234567890.0), ("q", 0.2), ("q", 0.2), ("a", 100.0), ("aA", 0.3),
    ("a", 0.5), ERROR,
]


def test_replies_read_as_listed(spark):
    df = spark.createDataFrame(list(enumerate(REPLIES)), "row_id int, raw string")
    for r in annotate.parse_label_responses(df).collect():
        assert (r["label_auto"], r["confidence"]) == READ[r["row_id"]], r["raw"]


def test_repeated_keys_are_refused(spark, texts):
    twice = spark.createDataFrame([(0, "{}"), (0, "{}")], "row_id long, raw string")
    with pytest.raises(ValueError, match="more than once"):
        annotate.auto_label(texts, annotate.stored_replies(twice))
    labeled = spark.createDataFrame([(0, "t", "a", 0.1)], "row_id long, text string, label_auto string, confidence double")
    fixes = spark.createDataFrame([(0, "t", "b", 1.0)] * 2, "row_index long, text string, label_auto string, confidence double")
    for mode in ("upsert", "replace"):
        with pytest.raises(ValueError, match="more than once"):
            review.apply_corrections(labeled, fixes, mode=mode)
        with pytest.raises(ValueError, match="more than once"):
            review.replace_with_reviewed(labeled, fixes, mode=mode)


def test_reply_types(spark):
    raws = ['{"label": 5, "confidence": 1}', '{"label":"a","confidence":"nan"}', None]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [(r[1], r[2]) for r in annotate.parse_label_responses(df).collect()]
    assert got == [("5", 1.0), ("a", None), ("error", 0.0)]


def test_known_label_quality(spark, sf_dir):
    quality = annotate.label_quality(view(spark, sf_dir, "labeled"), "human_label").first()
    assert quality["confidence_mean"] == pytest.approx(0.4645557851239669)
    assert quality["confidence_low_pct"] == pytest.approx(0.696)
    assert quality["error_rate"] == pytest.approx(0.059)
    assert quality["agreement"] == pytest.approx(0.3188097768331562)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(0, "good"), (1, "bad"), (2, None), (3, "x" * 900)], "row_id long, text string"
    )


def test_prompt_holds_classes_and_500_characters(texts):
    prompts = {r[0]: r[1] for r in annotate.build_label_prompts(texts, labels=["a", "b"]).collect()}
    assert "classes: a, b.\n\nText:\ngood\n\nRespond ONLY" in prompts[0]
    assert "Text:\nnan\n" in prompts[2]
    assert prompts[3].count("x" * 500) == 1 and "x" * 501 not in prompts[3]


def test_function_labeler_and_limits(texts):
    def answer(prompt):
        label = "positive" if "\ngood\n" in prompt else "other"
        return json.dumps({"label": label, "confidence": 0.9})

    labeler = annotate.function_labeler(answer)
    got = annotate.auto_label(texts, labeler, n=None).orderBy("row_id").collect()
    assert [r["label_auto"] for r in got] == ["positive", "other", "other", "other"]
    strict = annotate.auto_label(texts, labeler, n=2, strict=True).orderBy("row_id").collect()
    assert [(r["label_auto"], r["confidence"]) for r in strict] == [("positive", 0.9), ("error", 0.0)]
    with pytest.raises(NotImplementedError):
        annotate.auto_label(texts, labeler, modality="audio")


def test_each_request_is_answered_once(spark, texts, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def answer(prompt):
        if "bad" in prompt:
            raise OSError("no reply")
        (log / str(time.time_ns())).touch()
        return '{"label": "neutral", "confidence": 0.6}'

    done = annotate.annotate(texts, annotate.function_labeler(answer), n=None)
    assert done.quality.first()["error_rate"] == 0.25
    assert done.tasks.count() == 4 and done.guide_prompt.count() == 1
    assert {r["value"]: r["n"] for r in done.label_dist.collect()} == {"neutral": 3, "error": 1}
    assert len(list(log.iterdir())) == 3


def test_replies_are_stored_by_prompt(spark, texts, tmp_path):
    log, fails = tmp_path / "calls", tmp_path / "down"
    log.mkdir()
    fails.touch()

    def answer(prompt):
        (log / str(time.time_ns())).touch()
        if "bad" in prompt and fails.exists():
            raise OSError("no reply")
        return '{"label": "neutral", "confidence": 0.6}'

    path = str(tmp_path / "store")
    labeler = annotate.reply_store(answer, path)
    copies = texts.unionByName(texts.withColumn("row_id", F.col("row_id") + 100))
    labels = lambda: {r["row_id"]: r["label_auto"] for r in annotate.auto_label(copies, labeler).collect()}
    first = labels()
    assert sorted(first.values()) == ["error"] * 2 + ["neutral"] * 6
    assert len(list(log.iterdir())) == 4  # each distinct prompt once
    errors = annotate.stored_answers(spark, path).where("error IS NOT NULL").collect()
    assert [r["error"] for r in errors] == ["OSError: no reply"]
    fails.unlink()
    assert set(labels().values()) == {"neutral"}
    assert len(list(log.iterdir())) == 5  # only what failed was asked again
    assert set(labels().values()) == {"neutral"} and len(list(log.iterdir())) == 5
    assert annotate.auto_label(texts.where("false"), labeler).count() == 0


def test_missing_reply_is_an_error(spark, texts):
    replies = spark.createDataFrame(
        [(0, '{"label": "positive", "confidence": 1}'), (77, "{}")], "row_id long, raw string"
    )
    got = annotate.auto_label(texts, annotate.stored_replies(replies), n=None)
    assert {r["row_id"]: r["label_auto"] for r in got.collect()} == {
        0: "positive", 1: "error", 2: "error", 3: "error",
    }


def test_guide_prompt(texts):
    prompt = annotate.build_guide_prompt(texts, k=10).first()["prompt"]
    start = prompt.rindex("[", 0, prompt.index("good"))
    assert json.loads(prompt[start : prompt.rindex("]") + 1]) == ["good", "bad", "x" * 900]
    with pytest.raises(ValueError):
        annotate.build_guide_prompt(texts, k=10**6)


def test_task_without_usable_label_has_no_prediction(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, "t", "positive", 0.5), (1, "t", "error", 0.0), (2, "t", None, 0.1), (3, None, "", 0.2)],
        "row_id long, text string, label_auto string, confidence double",
    )
    path = str(tmp_path / "tasks")
    sinks.write_tasks(annotate.label_tasks(df, model="m"), path)
    tasks = {t["id"]: t for t in (json.loads(r[0]) for r in spark.read.text(path).collect())}
    assert tasks[0]["predictions"] == [
        {"model_version": "m", "score": 0.5,
         "result": [{"from_name": "sentiment", "to_name": "text", "type": "choices",
                     "value": {"choices": ["positive"]}}]}
    ]
    assert [tasks[i]["predictions"] for i in (1, 2, 3)] == [[], [], []]
    assert tasks[3]["data"] == {"text": "nan"}


@pytest.fixture(scope="module")
def labeled(spark):
    return spark.createDataFrame(
        [(0, "a", "positive", 0.9), (1, 'say "b",\n twice ', "negative", 0.2), (2, "c", "error", 0.0),
         (3, "d", None, None), (4, " e", "neutral", 0.7)],
        "row_id long, text string, label_auto string, confidence double",
    )


def test_filters(labeled):
    def ids(df):
        return {r["row_id"] for r in df.collect()}

    assert ids(filters.filter_low_confidence(labeled)) == {1, 2}
    assert ids(filters.filter_valid_labels(labeled)) == {0, 1, 4}
    assert ids(filters.drop_error_labels(labeled)) == {0, 1, 3, 4}
    assert ids(filters.drop_null_rows(labeled)) == {0, 1, 2, 4}


def test_queue_round_trip(spark, labeled, tmp_path):
    path = str(tmp_path / "queue")
    sinks.export_review_queue(labeled, path)
    back = tables.read_corrections(spark, path)
    assert sorted(map(str, back.collect())) == sorted(
        map(str, review.review_queue(labeled).collect())
    )


def test_repeated_correction_is_refused(spark, tmp_path):
    path = str(tmp_path / "twice")
    twice = spark.createDataFrame(
        [(1, "a", "x", 1.0), (1, "a", "y", 1.0)],
        "row_index long, text string, label_auto string, confidence double",
    )
    sinks.write_table(twice, path, "csv")
    with pytest.raises(ValueError, match="more than once"):
        tables.read_corrections(spark, path)


def test_corrections(spark, labeled):
    new = spark.createDataFrame(
        [(1, "b", "positive", 1.0), (2, "c", "neutral", None)],
        "row_index long, text string, label_auto string, confidence double",
    )
    up = {r["row_id"]: r for r in review.apply_corrections(labeled, new).collect()}
    assert len(up) == 5
    assert (up[1]["label_auto"], up[1]["confidence"]) == ("positive", 1.0)
    assert up[2]["confidence"] is None and up[0]["label_auto"] == "positive"
    replaced = review.apply_corrections(labeled, new, mode="replace")
    assert {r["row_id"] for r in replaced.collect()} == {0, 4, 1, 2}
    assert review.replace_with_reviewed(labeled, new).count() == 2
    assert review.replace_with_reviewed(labeled, new, mode="upsert").count() == 5
    with pytest.raises(ValueError):
        review.apply_corrections(labeled, new, mode="?")


def test_take_and_remove_partition_the_pool(spark, labeled):
    ids = spark.createDataFrame([(1,), (3,), (99,)], "row_id long")
    taken, left = review.take_rows(labeled, ids), review.remove_rows(labeled, ids)
    assert taken.count() == 2 and taken.unionByName(left).exceptAll(labeled).count() == 0
    assert left.agg(F.count("*")).first()[0] == 3
