"""Sinks: stage tables, review queues, label tasks, metrics, fitted models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions.columns import ROW_ID, small_table
from labelmill.operators.learn import Classifier, Scorer, coefficient_rows, scorer_from
from labelmill.operators.review import QUEUE_COLUMNS, review_queue


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Overwrite a stage table as parquet, CSV (with header) or JSON Lines."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.csv(
            path, header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    else:
        writer.format(format).save(path)


def export_review_queue(
    df: DataFrame, path: str, id_col: str = ROW_ID, cols: tuple[str, ...] = QUEUE_COLUMNS
) -> None:
    """Write the queue a reviewer edits, one CSV row per table row."""
    write_table(review_queue(df, id_col, cols), path, "csv")


def write_tasks(tasks: DataFrame, path: str) -> None:
    """Write label tasks as JSON Lines, one file per partition."""
    tasks.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write a metrics table as JSON Lines."""
    metrics.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_learning_report(config: dict, history: DataFrame, savings: DataFrame, path: str) -> None:
    """Write config, histories and savings of a comparison as one JSON object."""
    spark = history.sparkSession
    head = spark.range(1).select(
        F.struct(
            *[
                (F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)).alias(k)
                for k, v in config.items()
            ]
        ).alias("config")
    )
    # A history has a few records per strategy.
    records = history.agg(
        F.array_sort(F.collect_list(F.struct("strategy", *[c for c in history.columns
                                                           if c != "strategy"])))
    )
    saved = savings.select(F.struct(*savings.columns))
    report = head.withColumns({"histories": records.scalar(), "savings": saved.scalar()})
    write_metrics(report, path)


@dataclass
class SavedModel:
    classifier: Classifier
    vocabulary: DataFrame


def save_model(classifier: Classifier, vocabulary: DataFrame, path: str) -> None:
    """Write the vocabulary with its idf, the class list, and the fitted model."""
    spark = vocabulary.sparkSession
    vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    classes = small_table(spark, list(enumerate(classifier.classes)), "ix int, class string")
    classes.write.mode("overwrite").parquet(f"{path}/classes")
    classifier.model.write().overwrite().save(f"{path}/model")


def save_scorer(scorer: Scorer, vocabulary: DataFrame, path: str) -> None:
    """Write a linear model as tables: the vocabulary, the class list, the coefficients."""
    vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    classes = small_table(vocabulary.sparkSession, list(enumerate(scorer.classes)), "ix int, class string")
    classes.write.mode("overwrite").parquet(f"{path}/classes")
    coefficient_rows(scorer, vocabulary).write.mode("overwrite").parquet(f"{path}/coefficients")


def load_scorer(spark: SparkSession, path: str) -> tuple[Scorer, DataFrame]:
    """The scorer and the vocabulary of ``save_scorer``."""
    classes = [r["class"] for r in spark.read.parquet(f"{path}/classes").orderBy("ix").collect()]
    vocabulary = spark.read.parquet(f"{path}/vocabulary")
    return scorer_from(spark.read.parquet(f"{path}/coefficients"), classes, vocabulary.count()), vocabulary


def load_model(spark: SparkSession, path: str) -> SavedModel:
    classes = [r["class"] for r in spark.read.parquet(f"{path}/classes").orderBy("ix").collect()]
    model = LogisticRegressionModel.load(f"{path}/model")
    return SavedModel(Classifier(model, classes), spark.read.parquet(f"{path}/vocabulary"))
