"""Multinomial logistic regression on TF-IDF rows, prediction and metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import LABEL, bound, lookup, small_side

MAX_ITERATIONS = 1000
TOLERANCE = 1e-5
MAX_CLASSES = 1000
# Rows that one task of a fit holds in memory, and tasks beyond which gradients are added up in three levels.
ROWS_PER_TASK, DEEP_TASKS = 20_000, 1000
# Cells (classes times terms) that a coefficient table brings to the driver.
MAX_COEFFICIENTS = 10_000_000


@dataclass
class Classifier:
    model: LogisticRegressionModel
    classes: list[str]
    #: Steps of the fit, if this session made it.
    iterations: int | None = None


def fit_classifier(
    vectors: DataFrame,
    label: str = LABEL,
    c: float = 1.0,
    max_iter: int = MAX_ITERATIONS,
    tol: float = TOLERANCE,
) -> Classifier:
    """L2-penalised logistic regression; classes are the sorted labels present, as text.

    The penalty of ½‖w‖² + C·Σ loss is 1/(C·n) per row of the mean loss.
    """
    truth = F.col(label).cast("string")
    counts = vectors.groupBy(truth.alias("class")).count()
    seen = counts.orderBy("class").limit(MAX_CLASSES + 1).collect()
    classes = [r["class"] for r in seen]
    if not 2 <= len(classes) <= MAX_CLASSES or None in classes:
        raise ValueError(f"need 2 to {MAX_CLASSES} classes and no missing label: {classes[:5]}")
    n = sum(r["count"] for r in seen)
    index = F.array_position(F.array(*[F.lit(k) for k in classes]), truth) - 1
    # As many tasks as the rows need: every step of the fit is a job over all of them, and
    # with few of them its partial gradients are added up without a stage in between.
    tasks = -(-n // ROWS_PER_TASK)
    rows = vectors.select(index.cast("double").alias("label"), "features").coalesce(tasks)
    regression = LogisticRegression(
        maxIter=max_iter, regParam=1.0 / (c * n), elasticNetParam=0.0,
        standardization=False, tol=tol, aggregationDepth=2 if tasks <= DEEP_TASKS else 3,
    )
    model = regression.fit(rows)
    return Classifier(model, classes, model.summary.totalIterations)


@dataclass
class Scorer:
    """A linear model as numbers: weights by class and place of the term, one intercept a class.

    Two classes may have one row of weights, that of the second against the first.
    """

    classes: list[str]
    weights: list[list[float]]
    intercepts: list[float]


def scorer_of(classifier: Classifier) -> Scorer:
    """The coefficients of a fitted model."""
    matrix = classifier.model.coefficientMatrix.toArray()
    return Scorer(classifier.classes, matrix.tolist(), classifier.model.interceptVector.toArray().tolist())


def coefficient_rows(scorer: Scorer, vocabulary: DataFrame) -> DataFrame:
    """A scorer as a table (class, ix, weight); ix is null for the intercept."""
    names = scorer.classes if len(scorer.weights) > 1 else scorer.classes[1:]
    rows = [(name, [float(w) for w in row], float(b)) for name, row, b in zip(names, scorer.weights, scorer.intercepts)]
    table = vocabulary.sparkSession.createDataFrame(rows, "class string, weights array<double>, b double")
    cells = table.select("class", F.posexplode("weights").alias("ix", "weight"))
    return cells.unionByName(table.select("class", F.lit(None).cast("int").alias("ix"), F.col("b").alias("weight")))


def scorer_from(table: DataFrame, classes: Sequence[str], size: int) -> Scorer:
    """The scorer of a stored table (class, ix, weight); missing cells are 0.

    At most MAX_COEFFICIENTS cells are read.
    """
    if size * len(classes) > MAX_COEFFICIENTS:
        raise ValueError(f"{size * len(classes)} coefficients; at most {MAX_COEFFICIENTS} are read")
    cells = table.select("class", "ix", F.col("weight").cast("double").alias("weight")).limit((size + 1) * len(classes) + 1).collect()
    held = {r["class"] for r in cells}
    one = len(classes) == 2 and held <= {classes[1]}
    names = list(classes[1:] if one else classes)
    if len(cells) > (size + 1) * len(names) or held - set(names):
        raise ValueError("cells of other classes or repeated ones")
    weights, intercepts = [[0.0] * size for _ in names], [0.0] * len(names)
    for r in cells:
        k = names.index(r["class"])
        if r["ix"] is None:
            intercepts[k] = r["weight"]
        else:
            weights[k][r["ix"]] = r["weight"]
    return Scorer(list(classes), weights, intercepts)


def class_probabilities(scorer: Scorer, indices: Column, values: Column) -> Column:
    """Softmax of the class scores of a sparse row, in expressions of the row alone."""
    size = len(scorer.weights[0])
    flat = lookup([w for row in scorer.weights for w in row])

    def score(k: Column, b: Column) -> Column:
        terms = F.zip_with(indices, values, lambda i, v: v * F.get(flat, k * size + i))
        return F.aggregate(terms, b, lambda acc, x: acc + x)

    ks = F.sequence(F.lit(0), F.lit(len(scorer.weights) - 1))
    scores = F.zip_with(ks, lookup(scorer.intercepts), score)
    if len(scorer.weights) < len(scorer.classes):
        scores = F.concat(F.array(F.lit(0.0)), scores)

    def softmax(raw: Column) -> Column:
        return bound(F.transform(raw, lambda x: F.exp(x - F.array_max(raw))),
                     lambda e: bound(F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(e, lambda x: x / total)))

    return bound(scores, softmax)


def predict(classifier: Classifier | Scorer, vectors: DataFrame) -> DataFrame:
    """Add ``probs`` (by class order) and ``prediction``, the first of the likeliest; drop the vectors.

    Vectors are sparse or dense. Only expressions of the row are evaluated, so the plan
    holds the coefficients and neither a model object nor a session. A null vector has
    no probabilities; an empty one has those of the intercepts.
    """
    scorer = classifier if isinstance(classifier, Scorer) else scorer_of(classifier)
    parts = vectors.withColumn("_v", F.unwrap_udt("features"))
    size = len(scorer.weights[0])
    indices = F.when(F.col("_v.type") == 0, F.col("_v.indices")).otherwise(F.sequence(F.lit(0), F.lit(max(size - 1, 0))))
    probs = class_probabilities(scorer, indices, F.col("_v.values"))
    scored = parts.withColumn("probs", F.when(F.col("_v").isNotNull(), probs))
    names = F.array(*[F.lit(k) for k in scorer.classes])
    return scored.select(
        *[c for c in vectors.columns if c != "features"],
        "probs",
        bound(F.col("probs"), lambda p: F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))).alias("prediction"),
    )


def fit_report(classifier: Classifier, vectors: DataFrame, label: str = LABEL, c: float = 1.0) -> DataFrame:
    """One row on a fit over its rows: n, iterations, mean loss, objective, and the norm of the objective's gradient.

    The objective is mean loss + ‖w‖² / (2·C·n), which the fit minimises: a norm near 0 says
    that it stopped at the minimum. Cells of the gradient combine before the shuffle, and
    there are as many as coefficients. Vectors are sparse, labels are the classifier's.
    """
    scorer = scorer_of(classifier)
    two = len(scorer.weights) < len(scorer.classes)
    size = len(scorer.weights[0])
    sparse = vectors.select(F.col(label).cast("string").alias("y"), F.unwrap_udt("features").alias("v"))
    scored = sparse.select("y", "v", class_probabilities(scorer, F.col("v.indices"), F.col("v.values")).alias("probs"))
    names = F.array(*[F.lit(k) for k in scorer.classes])
    place = F.array_position(names, F.col("y"))
    away = F.transform("probs", lambda p, k: p - (k + 1 == place).cast("double"))
    rows = scored.select("v", F.slice(away, 2, 1).alias("away") if two else away.alias("away"), (-F.log(F.get("probs", place.cast("int") - 1))).alias("loss"))
    n, loss = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss")).first()
    # place -1 holds the intercept, which has no penalty
    pairs = F.concat(F.array(F.struct(F.lit(-1).alias("ix"), F.lit(1.0).alias("x"))), F.arrays_zip(F.col("v.indices").alias("ix"), F.col("v.values").alias("x")))
    cells = rows.select(F.posexplode("away").alias("class", "d"), pairs.alias("pairs")).select("class", "d", F.inline("pairs").alias("ix", "x"))
    sums = cells.groupBy("class", "ix").agg(F.sum(F.col("d") * F.col("x")).alias("g"))
    flat = lookup([w for row in scorer.weights for w in row])
    weight = F.when(F.col("ix") >= 0, F.get(flat, F.col("class") * size + F.col("ix"))).otherwise(0.0)
    seen = sums.select(weight.alias("w"), (F.col("g") / n + weight / (c * n)).alias("g"))
    squares = sum(w * w for row in scorer.weights for w in row)
    # terms that occur in no row have their penalty's gradient alone
    met = seen.agg(F.sum(F.col("g") ** 2).alias("g2"), F.sum(F.col("w") ** 2).alias("w2"))
    unmet = F.greatest(F.lit(squares) - F.col("w2"), F.lit(0.0)) / (c * n) ** 2
    return met.select(
        F.lit(n).cast("bigint").alias("n"), F.lit(classifier.iterations).alias("iterations"), F.lit(loss).alias("mean_loss"),
        F.lit(loss + squares / (2 * c * n)).alias("objective"), F.sqrt(F.col("g2") + unmet).alias("gradient_norm"),
    )


def classification_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and macro F1 over the classes seen in truth or prediction.

    Only the confusion counts leave the map side.
    """
    confusion = predictions.groupBy(
        F.col(label).cast("string").alias("truth"), F.col(prediction).cast("string").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col("truth").eqNullSafe(F.col("guess"))
    sides = F.array(
        F.struct(F.col("truth").alias("class"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).alias("fp"), F.when(~hit, F.col("n")).otherwise(0).alias("fn"),
                 F.col("n").alias("rows")),
        F.struct(F.col("guess").alias("class"), F.lit(0).alias("tp"),
                 F.when(~hit, F.col("n")).otherwise(0).alias("fp"), F.lit(0).alias("fn"),
                 F.lit(0).alias("rows")),
    )
    per_class = confusion.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "rows")]
    )
    f1 = 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return per_class.agg(
        F.coalesce(F.try_divide(F.sum("tp"), F.sum("rows")), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.avg(f1), F.lit(0.0)).alias("f1"),
    )


def evaluate(train: DataFrame, test: DataFrame, label: str = LABEL, **fit) -> DataFrame:
    """Fit on ``train``, predict ``test``: one row (accuracy, f1)."""
    return evaluate_fitted(fit_classifier(train, label, **fit), test, label)


def evaluate_fitted(classifier: Classifier, test: DataFrame, label: str = LABEL) -> DataFrame:
    return classification_metrics(predict(classifier, test), label, "prediction")


def coefficient_table(classifier: Classifier, vocabulary: DataFrame) -> DataFrame:
    """Fitted weights as (class, term, weight); a two-class model has one row set."""
    size = classifier.model.numFeatures * max(1, classifier.model.numClasses)
    if size > MAX_COEFFICIENTS:
        raise ValueError(f"{size} coefficients; at most {MAX_COEFFICIENTS} are tabled")
    matrix = classifier.model.coefficientMatrix.toArray()
    names = classifier.classes if len(matrix) > 1 else classifier.classes[1:]
    # The matrix is on the driver already: classes times vocabulary.
    weights = vocabulary.sparkSession.createDataFrame(
        [(name, [float(w) for w in row]) for name, row in zip(names, matrix)],
        "class string, weights array<double>",
    )
    cells = weights.select("class", F.posexplode("weights").alias("ix", "weight"))
    return cells.join(small_side(vocabulary.select("ix", "term")), "ix").select(
        "class", "term", "weight"
    )
