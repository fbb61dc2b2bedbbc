"""Active learning: scores, queries, learning cycles, strategy comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import LABEL, ROW_ID, TEXT, bound, seeded_uniform
from labelmill.functions.ranks import first_scored
from labelmill.operators.features import MAX_FEATURES, tfidf_vectors
from labelmill.operators.filters import filter_valid_labels
from labelmill.operators.history import history_table, sample_savings
from labelmill.operators.learn import Classifier, evaluate_fitted, fit_classifier, predict
from labelmill.operators.order import SEED, learning_sizes, seed_pool_sizes, split_by_rank
from labelmill.operators.review import remove_rows, take_rows
from labelmill.storage import new_stage_path, stage_counted

STRATEGIES = ("entropy", "random")
ITERATIONS = 5
BATCH = 10
MIN_SELECTABLE = 20
SCORE_DIGITS = 12


def entropy_score(probs: Column) -> Column:
    """-Σ p ln p of the renormalised probabilities; 0 ln 0 is 0, a sum of 0 gives 0."""
    def of(ps: Column) -> Column:
        return bound(F.aggregate(ps, F.lit(0.0), lambda acc, p: acc + p), lambda total: entropy(ps, total))

    def entropy(ps: Column, total: Column) -> Column:
        def add(acc: Column, p: Column) -> Column:
            return acc - bound(F.try_divide(p, total), lambda q: F.when(q > 0, q * F.log(q)).otherwise(F.lit(0.0)))

        return F.aggregate(ps, F.lit(0.0), add)

    return bound(probs, of)


def margin_score(probs: Column) -> Column:
    """Second highest minus highest probability."""
    ordered = F.sort_array(probs, asc=False)
    return -(F.get(ordered, 0) - F.get(ordered, 1))


def random_score(id_col: str = ROW_ID, seed: int | str = SEED) -> Column:
    """Repeatable uniform number of a row."""
    return seeded_uniform(id_col, seed)


# A score gets (probs, id column, seed); higher is picked first.
Score = Callable[[Column, str, object], Column]
SCORES: dict[str, Score] = {
    "entropy": lambda probs, id_col, seed: entropy_score(probs),
    "margin": lambda probs, id_col, seed: margin_score(probs),
    "random": lambda probs, id_col, seed: random_score(id_col, seed),
}


def query_pool(
    pool: DataFrame,
    strategy: str = "entropy",
    k: int = BATCH,
    id_col: str = ROW_ID,
    probs: str = "probs",
    seed: int | str = SEED,
) -> DataFrame:
    """Ids and scores of the ``k`` most informative rows; ties go to the lower id.

    Scores are rounded to SCORE_DIGITS, so that equal ones do not differ by the order
    in which they were summed. A row without a score comes last. Scores are computed once
    for each row of the pool, into a written table of (id, score). Rows are in that order.
    """
    if strategy not in SCORES:
        raise ValueError(f"unknown strategy: {strategy!r}")
    score = SCORES[strategy](F.col(probs), id_col, seed)
    scored = pool.select(id_col, F.round(score, SCORE_DIGITS).alias("score"))
    return first_scored(scored, k, id_col).orderBy(F.desc_nulls_last("score"), id_col)


def run_cycle(
    labeled: DataFrame,
    pool: DataFrame,
    test: DataFrame,
    strategy: str = "entropy",
    n_iterations: int = ITERATIONS,
    batch_size: int = BATCH,
    label: str = LABEL,
    id_col: str = ROW_ID,
    seed: int = SEED,
    **fit,
) -> tuple[list[dict], DataFrame]:
    """One learning cycle over staged vectors: its history and the picked rows by iteration.

    Each batch is appended to a written table, so plans stay the same length, a
    fit reads no more than the labelled rows, and a lost executor costs no
    earlier iteration. A batch that would never be evaluated is not queried.
    """
    if strategy not in SCORES:
        raise ValueError(f"unknown strategy: {strategy!r}")
    spark = pool.sparkSession
    path = new_stage_path(spark, "picked")
    n_labeled, n_pool = labeled.count(), pool.count()
    history: list[dict] = []
    now_labeled, now_pool = labeled, pool
    batches = pool.withColumn("iteration", F.lit(0)).where(F.lit(False))
    for i in range(n_iterations):
        if n_pool == 0:
            break
        classifier = fit_classifier(now_labeled, label, **fit)
        scores = evaluate_fitted(classifier, test, label).first()
        history.append(
            {"iteration": i, "n_labeled": n_labeled, "accuracy": scores["accuracy"],
             "f1": scores["f1"], "strategy": strategy}
        )
        if i == n_iterations - 1:
            break
        batch = min(batch_size, n_pool)
        ids = query_pool(
            predict(classifier, now_pool), strategy, batch, id_col, seed=f"{seed}:{i}"
        )
        batch_rows = take_rows(now_pool, ids, id_col).withColumn("iteration", F.lit(i))
        batch_rows.write.mode("append").parquet(path)
        batches = spark.read.schema(batch_rows.schema).parquet(path)
        picked = batches.drop("iteration")
        now_labeled = labeled.unionByName(picked)
        now_pool = remove_rows(pool, picked, id_col)
        n_labeled, n_pool = n_labeled + batch, n_pool - batch
    return history, batches.select("iteration", id_col)


def al_cycle(labeled: DataFrame, pool: DataFrame, test: DataFrame, strategy: str = "entropy", **how) -> list[dict]:
    """The history of ``run_cycle``."""
    return run_cycle(labeled, pool, test, strategy, **how)[0]


@dataclass
class Comparison:
    """Histories, savings and the final model of a strategy comparison."""

    history: DataFrame
    savings: DataFrame
    config: dict
    classifier: Classifier
    vocabulary: DataFrame
    vectors: DataFrame


def compare_strategies(
    df: DataFrame,
    strategies: Sequence[str] = STRATEGIES,
    n_start: int = 50,
    n_iterations: int = ITERATIONS,
    batch_size: int = BATCH,
    text: str = TEXT,
    label: str = LABEL,
    id_col: str = ROW_ID,
    seed: int = SEED,
    max_features: int = MAX_FEATURES,
    sizes: Mapping[str, int | None] | None = None,
    fit_on: str = "all",
    **fit,
) -> Comparison:
    """Shuffle, split, and run one cycle per strategy on shared features.

    By default the vocabulary sees the test texts too; ``fit_on="train"`` leaves
    them out. The final model is fitted on every row.
    """
    spark = df.sparkSession
    rows = df.select(id_col, text, label).dropna(subset=[text, label])
    # one read of the input: texts and labels are written, and counted while they are
    rows, seen = stage_counted(rows, "rows", rows=F.count(F.lit(1)))
    n = seen["rows"]
    sizes = dict(sizes or learning_sizes(n, n_start))
    parts = split_by_rank(rows, sizes, id_col, seed, total=n)
    n_test = n - sizes["labeled"] - sizes["pool"]
    fitted, n_fitted = (None, n) if fit_on == "all" else (F.col("part") != "test", n - n_test)
    vocabulary, vectors = tfidf_vectors(
        parts, text, max_features, id_col, [label, "part"], "part", fitted, n_fitted
    )
    labeled, pool, test = (
        vectors.where(F.col("part") == p).drop("part") for p in ("labeled", "pool", "test")
    )

    @inheritable_thread_target(spark)
    def cycle(strategy: str) -> list[dict]:
        return run_cycle(
            labeled, pool, test, strategy, n_iterations, batch_size, label, id_col, seed, **fit
        )[0]

    @inheritable_thread_target(spark)
    def fit_all() -> Classifier:
        return fit_classifier(vectors, label, **fit)

    # The cycles and the final fit do not depend on one another, so their jobs may share the cluster.
    with ThreadPoolExecutor(max_workers=len(strategies) + 1) as threads:
        final = threads.submit(fit_all)
        histories = dict(zip(strategies, threads.map(cycle, strategies)))
        classifier = final.result()
    history = history_table(spark, histories)
    config = {
        "n_start": sizes["labeled"], "n_iterations": n_iterations, "batch_size": batch_size,
        "strategies": list(strategies), "dataset_size": n,
        "test_size": n_test,
    }
    return Comparison(
        history, sample_savings(history), config, classifier, vocabulary, vectors,
    )


def select_informative(
    df: DataFrame,
    k: int = 50,
    text: str = TEXT,
    label: str = LABEL,
    id_col: str = ROW_ID,
    seed: int = SEED,
    only_selected: bool = False,
    max_features: int = MAX_FEATURES,
    **fit,
) -> DataFrame:
    """Seed rows plus the ``k`` pool rows the model is least sure of.

    Under 20 valid rows, all of them pass through. ``only_selected`` leaves the
    seed rows out. The input is read once, its valid rows are written.
    """
    valid, seen = stage_counted(filter_valid_labels(df, label), "valid", rows=F.count(F.lit(1)))
    n = seen["rows"]
    if n < MIN_SELECTABLE:
        return valid
    parts = split_by_rank(valid, seed_pool_sizes(n), id_col, seed, total=n)
    _vocabulary, vectors = tfidf_vectors(parts, text, max_features, id_col, [label, "part"], "part", n=n)
    classifier = fit_classifier(vectors.where(F.col("part") == "seed"), label, **fit)
    pool = vectors.where(F.col("part") == "pool")
    picked = query_pool(predict(classifier, pool), "entropy", k, id_col)
    chosen = take_rows(parts.where(F.col("part") == "pool"), picked, id_col)
    if not only_selected:
        chosen = parts.where(F.col("part") == "seed").unionByName(chosen)
    return chosen.drop("part")
