"""Learning histories: stacking, sample savings, learning curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = "iteration int, n_labeled bigint, accuracy double, f1 double, strategy string"
TARGET_SHARE = 0.98


def history_table(spark: SparkSession, histories: Mapping[str, Sequence[dict]]) -> DataFrame:
    """Cycle records (a few per strategy) as a table."""
    rows = [
        (int(r["iteration"]), int(r["n_labeled"]), float(r["accuracy"]), float(r["f1"]), name)
        for name, history in histories.items()
        for r in history
    ]
    return spark.createDataFrame(rows, HISTORY_SCHEMA).coalesce(1)


def union_histories(histories: Mapping[str, DataFrame]) -> DataFrame:
    """Histories stacked under their strategy names; an empty one adds no row."""
    if not histories:
        raise ValueError("no history")
    result = None
    for name, history in histories.items():
        part = history.withColumn("strategy", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


def sample_savings(
    history: DataFrame,
    target: float | None = None,
    strategy: str = "entropy",
    baseline: str = "random",
) -> DataFrame:
    """Labels each strategy needs to reach the target, and what ``strategy`` saves.

    The default target is 98 % of the baseline's best accuracy. Values are null
    where the target is not reached or a history is empty.
    """
    if target is None:
        best = F.max(F.when(F.col("strategy") == baseline, F.col("accuracy")))
        goal = history.agg(best * F.lit(TARGET_SHARE)).scalar()
    else:
        goal = F.lit(float(target))

    def first_reach(name: str):
        hit = (F.col("strategy") == name) & (F.col("accuracy") >= F.col("target"))
        return F.min_by(F.when(hit, F.col("n_labeled")), F.when(hit, F.col("iteration")))

    mine, theirs = f"n_labeled_{strategy}", f"n_labeled_{baseline}"
    reached = history.withColumn("target", goal).agg(
        F.max("target").alias("target"),
        first_reach(strategy).alias(mine),
        first_reach(baseline).alias(theirs),
    )
    saved = F.col(theirs) - F.col(mine)
    pct = F.when(F.col(theirs) > 0, saved / F.col(theirs) * 100).otherwise(
        F.when(saved.isNotNull(), F.lit(0.0))
    )
    return reached.select(
        F.round("target", 4).alias("target_accuracy"),
        mine,
        theirs,
        saved.alias("samples_saved"),
        F.round(pct, 1).alias("savings_pct"),
    )


def learning_curve_pivot(
    history: DataFrame, strategies: Sequence[str] = ("entropy", "random")
) -> DataFrame:
    """Mean accuracy and f1 by number of labels, one column per strategy."""
    return (
        history.groupBy("n_labeled")
        .pivot("strategy", list(strategies))
        .agg(F.round(F.avg("accuracy"), 4).alias("accuracy"), F.round(F.avg("f1"), 4).alias("f1"))
    )
