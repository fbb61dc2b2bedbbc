"""TF-IDF, the classifier, active learning, histories."""

import json
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.operators import active, features, history, learn, order
from labelmill.plans.queries import view
from labelmill.sources import sinks


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        (0, "The cat sat. The CAT ran!", "a"), (1, "a dog ran, été_1 42", "b"),
        (2, "cat cat cat dog", "a"), (3, "! ? x", "b"), (4, None, "a"), (5, "", "b"),
        (6, "the end of the dog's day", "a"), (7, "Nan and the cat", "b"),
    ]
    return spark.createDataFrame(rows, "row_id long, text string, label_auto string")


def tfidf_by_hand(texts, max_features):
    docs = {i: re.findall(r"(?u)\b\w\w+\b", ("nan" if t is None else t).lower()) for i, t in texts}
    total = Counter(t for d in docs.values() for t in d)
    kept = sorted(sorted(total, key=lambda t: (-total[t], t))[:max_features])
    df = {t: sum(t in d for d in docs.values()) for t in kept}
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    rows = {}
    for i, d in docs.items():
        w = {t: (1 + math.log(n)) * idf[t] for t, n in Counter(d).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        rows[i] = {t: x / norm for t, x in w.items()}
    return kept, rows


@pytest.mark.parametrize("max_features", [3, 5, 100])
def test_tfidf_by_hand(texts, max_features):
    kept, expected = tfidf_by_hand([(r[0], r[1]) for r in texts.collect()], max_features)
    vocabulary = features.tfidf_fit(texts, max_features=max_features)
    assert [r["term"] for r in vocabulary.orderBy("ix").collect()] == kept
    sparse = features.tfidf_transform(texts, vocabulary)
    assert sparse.count() == 8  # rows without a known term stay
    cells = {(r[0], r[1]): r[2] for r in features.feature_table(sparse, vocabulary).collect()}
    wanted = {(i, t): w for i, row in expected.items() for t, w in row.items()}
    assert cells.keys() == wanted.keys()
    assert all(cells[k] == pytest.approx(w) for k, w in wanted.items())


def test_vocabulary_limit(texts):
    with pytest.raises(ValueError):
        features.tfidf_fit(texts, max_features=10**9)


@pytest.mark.parametrize("fitted", [None, "row_id > 3"])
@pytest.mark.parametrize("max_features", [3, 100])
def test_vectors_equal_fit_and_transform(texts, max_features, fitted):
    rows = texts.withColumn("part", F.when(F.col("row_id") % 2 == 0, "even").otherwise("odd"))
    mine = rows.where(fitted) if fitted else rows
    vocabulary = features.tfidf_fit(mine, max_features=max_features)
    expected = features.stage_vectors(features.tfidf_transform(rows, vocabulary, keep=["part"]), vocabulary.count(), "part")
    got, vectors = features.tfidf_vectors(
        rows, max_features=max_features, keep=["part"], part="part", fitted=F.expr(fitted) if fitted else None
    )
    assert got.orderBy("ix").collect() == vocabulary.orderBy("ix").collect()
    assert vectors.orderBy("row_id").collect() == expected.orderBy("row_id").collect()


def test_vectors_without_terms(spark):
    rows = spark.createDataFrame([(1, "?"), (2, "")], "row_id long, text string")
    with pytest.raises(ValueError, match="empty"):
        features.tfidf_vectors(rows)


def test_texts_are_split_once_for_the_totals(spark, monkeypatch):
    """Of each text the terms are counted in one split, and Spark adds no filter that splits again."""
    seen = []
    first = features.commonest
    monkeypatch.setattr(features, "commonest", lambda counts, *a: seen.append(counts) or first(counts, *a))
    rows = spark.createDataFrame([(1, "one two two"), (2, "two three")], "row_id long, text string")
    vocabulary, _vectors = features.tfidf_vectors(rows)
    assert {(r["term"], r["doc_freq"], r["total"]) for r in vocabulary.collect()} == {("one", 1, 1), ("two", 2, 3), ("three", 1, 1)}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    rows = view(spark, sf_dir, "reviews").where("original_label IS NOT NULL")
    parts = order.split_by_rank(rows, order.learning_sizes(rows.count()))
    vocabulary = features.tfidf_fit(rows, max_features=300)
    sparse = features.tfidf_transform(parts, vocabulary, keep=["original_label", "part"])
    return features.stage_vectors(sparse, vocabulary.count(), "part")


def gradient(fitted, rows):
    x = np.array([r["features"].toArray() for r in rows])
    y = np.eye(len(fitted.classes))[[fitted.classes.index(r["original_label"]) for r in rows]]
    w = fitted.model.coefficientMatrix.toArray()
    z = x @ w.T + fitted.model.interceptVector.toArray()
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return (p - y).T @ x / len(rows) + w / len(rows), p


def test_fit_is_the_penalised_optimum(vectors):
    fitted = learn.fit_classifier(vectors, "original_label", tol=1e-9)
    assert fitted.classes == ["negative", "neutral", "positive"]
    rows = vectors.collect()
    slope, p = gradient(fitted, rows)
    assert abs(slope).max() < 1e-5
    scored = {r["row_id"]: r for r in learn.predict(fitted, vectors).collect()}
    for r, expected in zip(rows, p):
        assert scored[r["row_id"]]["probs"] == pytest.approx(list(expected), abs=1e-9)
        assert scored[r["row_id"]]["prediction"] == fitted.classes[int(expected.argmax())]


def test_default_tolerance_predicts_alike(vectors):
    usual = learn.predict(learn.fit_classifier(vectors, "original_label"), vectors)
    exact = learn.predict(learn.fit_classifier(vectors, "original_label", tol=1e-9), vectors)
    one, two = ({r[0]: r[1] for r in d.select("row_id", "prediction").collect()} for d in (usual, exact))
    assert sum(one[k] != two[k] for k in one) <= 1


def test_one_class_is_refused(vectors):
    with pytest.raises(ValueError, match="2 to"):
        learn.fit_classifier(vectors.where("original_label = 'positive'"), "original_label")


def test_number_labels_are_read_as_text(spark):
    words = ["good fine", "bad poor", "plain dull"]
    df = spark.createDataFrame(
        [(i, f"{words[i % 3]} word{i % 7}", i % 3) for i in range(60)],
        "row_id long, text string, label_auto int",
    )
    chosen = active.select_informative(df, 5)
    assert chosen.count() == 36 + 5 and dict(chosen.dtypes)["label_auto"] == "int"
    vocabulary = features.tfidf_fit(df)
    sparse = features.tfidf_transform(df, vocabulary, keep=["label_auto"])
    vectors = features.stage_vectors(sparse, vocabulary.count())
    assert tuple(learn.evaluate(vectors, vectors).first()) == (1.0, 1.0)


def test_two_classes_and_saved_model(spark, vectors, texts, tmp_path):
    two = vectors.where("original_label <> 'neutral'")
    fitted = learn.fit_classifier(two, "original_label")
    vocabulary = features.tfidf_fit(texts)
    sinks.save_model(fitted, vocabulary, str(tmp_path / "model"))
    loaded = sinks.load_model(spark, str(tmp_path / "model"))
    assert loaded.classifier.classes == ["negative", "positive"]
    one, other = (learn.predict(c, vectors) for c in (fitted, loaded.classifier))
    assert one.exceptAll(other).count() == 0
    assert loaded.vocabulary.exceptAll(vocabulary).count() == 0
    again = features.tfidf_transform(texts, loaded.vocabulary)
    assert again.exceptAll(features.tfidf_transform(texts, vocabulary)).count() == 0
    row = one.first()
    assert sum(row["probs"]) == pytest.approx(1.0) and len(row["probs"]) == 2


def test_scorer_equals_the_fitted_model(spark, vectors, tmp_path):
    """Probabilities in expressions of the row against the model's own, for two and three classes, stored and loaded."""
    vocabulary = spark.range(300).selectExpr("cast(id AS INT) AS ix", "concat('t', id) AS term")
    for rows in (vectors, vectors.where("original_label <> 'neutral'")):
        fitted = learn.fit_classifier(rows, "original_label")
        data = vectors.collect()
        z = np.array([r["features"].toArray() for r in data]) @ fitted.model.coefficientMatrix.toArray().T + fitted.model.interceptVector.toArray()
        z = z if z.shape[1] > 1 else np.hstack([np.zeros_like(z), z])
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        own = {r["row_id"]: (x, fitted.classes[int(x.argmax())]) for r, x in zip(data, p)}
        path = str(tmp_path / f"scorer{len(fitted.classes)}")
        sinks.save_scorer(learn.scorer_of(fitted), vocabulary, path)
        for scorer in (fitted, sinks.load_scorer(spark, path)[0]):
            got = learn.predict(scorer, vectors).collect()
            assert len(got) == len(own)
            for r in got:
                assert r["probs"] == pytest.approx(own[r["row_id"]][0].tolist(), abs=1e-12)
                assert r["prediction"] == own[r["row_id"]][1]
    table = spark.createDataFrame([("a", 1, 2.0), ("b", None, 1.0)], "class string, ix int, weight double")
    assert learn.scorer_from(table, ["a", "b", "c"], 3) == learn.Scorer(["a", "b", "c"], [[0.0, 2.0, 0.0], [0.0] * 3, [0.0] * 3], [0.0, 1.0, 0.0])
    with pytest.raises(ValueError):
        learn.scorer_from(table, ["a", "c"], 3)


def test_fit_report_is_the_gradient(vectors):
    for rows in (vectors, vectors.where("original_label <> 'neutral'")):
        for tol in (1e-2, 1e-9):
            fitted = learn.fit_classifier(rows, "original_label", tol=tol)
            found = learn.fit_report(fitted, rows, "original_label").first()
            data = rows.collect()
            x = np.array([r["features"].toArray() for r in data])
            y = np.array([fitted.classes.index(r["original_label"]) for r in data])
            w, b = fitted.model.coefficientMatrix.toArray(), fitted.model.interceptVector.toArray()
            z = x @ w.T + b
            z = z if len(w) > 1 else np.hstack([np.zeros_like(z), z])
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            away = p - np.eye(len(fitted.classes))[y]
            away = away if len(w) > 1 else away[:, 1:]
            n, loss = len(data), -np.log(p[np.arange(len(data)), y]).mean()
            norm = np.sqrt(((away.T @ x / n + w / n) ** 2).sum() + (away.mean(0) ** 2).sum())
            assert found["n"] == n and found["iterations"] > 0
            assert found["mean_loss"] == pytest.approx(loss) and found["objective"] == pytest.approx(loss + (w**2).sum() / (2 * n))
            assert found["gradient_norm"] == pytest.approx(norm, rel=1e-6, abs=1e-9)
        assert found["gradient_norm"] < 1e-5


def test_picks_of_a_cycle_are_the_best_of_what_is_left(vectors):
    labeled, pool, test = (vectors.where(f"part = '{p}'").drop("part") for p in ("labeled", "pool", "test"))
    records, picks = active.run_cycle(labeled, pool, test, "random", 3, 7, "original_label")
    assert [r["n_labeled"] for r in records] == [50, 57, 64]
    rows = [(r["iteration"], r["row_id"]) for r in picks.collect()]
    assert sorted(i for i, _ in rows) == [0] * 7 + [1] * 7 and len({r for _, r in rows}) == 14


def test_metrics_of_a_single_answer(spark):
    # 42 of 100 right with one answer in three classes, as in the published run.
    truth = ["a"] * 42 + ["b"] * 30 + ["c"] * 28
    df = spark.createDataFrame([(t, "a") for t in truth], "label string, prediction string")
    got = learn.classification_metrics(df).first()
    assert got["accuracy"] == pytest.approx(0.42)
    assert got["f1"] == pytest.approx(0.19718309859154928)


def test_metrics_on_known_predictions(spark, sf_dir):
    got = learn.classification_metrics(view(spark, sf_dir, "predictions")).first()
    assert got["accuracy"] == pytest.approx(0.8356545961002786)
    assert got["f1"] == pytest.approx(0.7961731267100394)


def test_metrics_of_nothing(spark):
    got = learn.classification_metrics(spark.createDataFrame([], "label string, prediction string"))
    assert tuple(got.first()) == (0.0, 0.0)


def test_scores(spark):
    rows = [[0.5, 0.5, 0.0], [1.0, 0.0, 0.0], [0.2, 0.3, 0.5], [1 / 3] * 3, [2.0, 2.0, 4.0]]
    df = spark.createDataFrame(list(enumerate(rows)), "row_id long, probs array<double>")
    got = df.select(
        "probs", active.entropy_score(F.col("probs")).alias("e"),
        active.margin_score(F.col("probs")).alias("m"), active.random_score().alias("r"),
    ).collect()
    for p, e, m, r in got:
        q = [x / sum(p) for x in p]
        assert e == pytest.approx(-sum(x * math.log(x) for x in q if x))
        top = sorted(p)[::-1]
        assert m == pytest.approx(top[1] - top[0])
        assert 0 <= r < 1


def test_query_pool_edges(spark):
    df = spark.createDataFrame(
        [(i, [0.5, 0.5]) for i in range(5)] + [(9, [0.9, 0.1])], "row_id long, probs array<double>"
    )
    assert [r["row_id"] for r in active.query_pool(df, "entropy", 2).collect()] == [0, 1]
    assert active.query_pool(df, "margin", 99).count() == 6
    assert active.query_pool(df.limit(0), "entropy", 3).count() == 0
    one, two = (
        [r["row_id"] for r in active.query_pool(df, "random", 3, seed=s).collect()] for s in (1, 2)
    )
    assert one != two
    with pytest.raises(ValueError, match="unknown strategy"):
        active.query_pool(df, "best")


def test_cycle_moves_rows_and_stops_with_the_pool(vectors):
    labeled, pool, test = (
        vectors.where(F.col("part") == p).drop("part") for p in ("labeled", "pool", "test")
    )
    pool = pool.orderBy("row_id").limit(15)
    records = active.al_cycle(
        labeled, pool, test, "entropy", n_iterations=5, batch_size=10, label="original_label"
    )
    # 15 pool rows: batches of 10 and 5, the last one never evaluated.
    assert [(r["iteration"], r["n_labeled"]) for r in records] == [(0, 50), (1, 60)]
    assert all(0 <= r["accuracy"] <= 1 and 0 <= r["f1"] <= 1 for r in records)
    assert active.al_cycle(labeled, pool.limit(0), test, label="original_label") == []
    with pytest.raises(ValueError, match="unknown strategy"):
        active.al_cycle(labeled, pool, test, "best")


def test_comparison(spark, sf_dir, tmp_path):
    rows = view(spark, sf_dir, "reviews")
    result = active.compare_strategies(
        rows, n_iterations=2, label="original_label", max_features=200, fit_on="train", tol=1e-3
    )
    got = result.history.orderBy("strategy", "iteration").collect()
    assert [(r["strategy"], r["n_labeled"]) for r in got] == [
        ("entropy", 50), ("entropy", 60), ("random", 50), ("random", 60),
    ]
    # Both strategies start from the same rows.
    assert got[0]["accuracy"] == got[2]["accuracy"]
    assert result.config["dataset_size"] == 399 and result.config["test_size"] == 79
    path = str(tmp_path / "report")
    sinks.write_learning_report(result.config, result.history, result.savings, path)
    report = json.loads(spark.read.text(path).first()[0])
    assert report["config"]["strategies"] == ["entropy", "random"]
    assert len(report["histories"]) == 4 and "target_accuracy" in report["savings"]


def test_selection(spark, sf_dir):
    labeled = view(spark, sf_dir, "labeled").where("human_label IS NOT NULL")
    valid = labeled.where("label_auto IS NOT NULL AND label_auto <> 'error'").count()
    chosen = active.select_informative(labeled, 20, max_features=200, tol=1e-3)
    assert chosen.columns == labeled.columns
    assert chosen.count() == int(0.6 * valid) + 20
    assert chosen.select("row_id").distinct().count() == chosen.count()
    few = labeled.where("row_id < 40")
    passed = active.select_informative(few)
    assert passed.where("label_auto = 'error'").count() == 0
    assert passed.count() < active.MIN_SELECTABLE


PUBLISHED = {
    "entropy": [(0, 15, 0.42, 0.19718309859154928), (1, 25, 0.42, 0.19718309859154928)],
    "random": [(0, 15, 0.42, 0.19718309859154928), (1, 25, 0.5, 0.317948717948718)],
}


@pytest.fixture(scope="module")
def published(spark):
    names = ("iteration", "n_labeled", "accuracy", "f1")
    return history.history_table(
        spark, {s: [dict(zip(names, r)) for r in rows] for s, rows in PUBLISHED.items()}
    )


def test_published_savings(published):
    got = tuple(history.sample_savings(published).first())
    assert got == (0.49, None, 25, None, None)
    assert tuple(history.sample_savings(published, target=0.4).first()) == (0.4, 15, 15, 0, 0.0)
    empty = history.sample_savings(published.limit(0)).first()
    assert tuple(empty) == (None,) * 5


def test_savings_when_reached_earlier(spark):
    df = spark.createDataFrame(
        [(0, 20, 0.6, 0.5, "entropy"), (1, 30, 0.9, 0.8, "entropy"), (2, 40, 0.7, 0.6, "entropy"),
         (0, 20, 0.5, 0.4, "random"), (1, 30, 0.6, 0.5, "random"), (2, 40, 0.9, 0.8, "random")],
        history.HISTORY_SCHEMA,
    )
    assert tuple(history.sample_savings(df).first()) == (0.882, 30, 40, 10, 25.0)


def test_curve_and_union(published):
    curve = {r["n_labeled"]: r for r in history.learning_curve_pivot(published).collect()}
    assert curve[25]["random_accuracy"] == 0.5 and curve[25]["entropy_f1"] == 0.1972
    parts = {s: published.where(F.col("strategy") == s) for s in PUBLISHED}
    stacked = history.union_histories({**parts, "margin": published.limit(0)})
    assert stacked.exceptAll(published).count() == 0 and stacked.count() == 4
    with pytest.raises(ValueError):
        history.union_histories({})
