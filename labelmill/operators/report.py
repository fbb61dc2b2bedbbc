"""Metrics of a whole run as long tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import LABEL, ROW_ID, content_columns
from labelmill.operators.active import MIN_SELECTABLE
from labelmill.operators.annotate import label_summary
from labelmill.operators.filters import LOW_CONFIDENCE, no_error_label, valid_label
from labelmill.operators.history import sample_savings
from labelmill.operators.profile import content_totals, value_counts


@dataclass
class Stages:
    """Tables of one run; optional ones stand for steps a reviewer skipped."""

    raw: DataFrame
    clean: DataFrame
    labeled: DataFrame
    reviewed: DataFrame
    final: DataFrame
    corrections: DataFrame | None = None
    al_corrections: DataFrame | None = None
    threshold: float = LOW_CONFIDENCE
    n_select: int = 50
    strategy: Mapping[str, str] | None = None
    approved: bool = False
    #: Rows that were counted while the tables were written, by the names of ``COUNTS``.
    counts: Mapping[str, int] | None = None

    def count(self, name: str) -> DataFrame:
        """One row with the count of that name: a known number, or a scan of its table."""
        known = (self.counts or {}).get(name)
        if known is not None:
            return self.raw.sparkSession.range(1).select(F.lit(int(known)).cast("bigint").alias(name))
        table, rows = COUNTS[name]
        return getattr(self, table).where(rows()).agg(F.count(F.lit(1)).alias(name))


#: What is counted of which table.
COUNTS: dict[str, tuple[str, Callable[[], Column]]] = {
    "n_clean": ("clean", lambda: F.lit(True)),
    "n_valid": ("reviewed", valid_label),
    "n_final": ("final", lambda: F.lit(True)),
    "n_good": ("final", no_error_label),
}


def counts_of(table: str) -> dict[str, Column]:
    """The aggregates of ``COUNTS`` over one table, to be taken while it is written."""
    return {name: F.count_if(rows()) for name, (of, rows) in COUNTS.items() if of == table}


Entry = tuple[str, str, Column | None, Column | None]


def _rows(df: DataFrame, entries: list[Entry]) -> DataFrame:
    """(step, metric, value, text) rows from the one row of an aggregate."""
    structs = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(metric).alias("metric"),
            (F.lit(None) if value is None else value).cast("double").alias("value"),
            (F.lit(None) if text is None else text).cast("string").alias("text"),
        )
        for step, metric, value, text in entries
    ]
    return df.select(F.inline(F.array(*structs)))


def _values(step: str, metrics: dict[str, Column]) -> list[Entry]:
    return [(step, name, value, None) for name, value in metrics.items()]


def _counted(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _one_row(*dfs: DataFrame) -> DataFrame:
    """Single-row aggregates side by side, the later ones as scalar subqueries."""
    first, *others = dfs
    rows = {f"_{i}": df.select(F.struct(*df.columns)).scalar() for i, df in enumerate(others)}
    return first.withColumns(rows).select(*first.columns, *[f"{name}.*" for name in rows])


def _label_dist(df: DataFrame, step: str) -> DataFrame:
    return value_counts(df, LABEL).select(
        F.lit(step).alias("step"),
        F.lit("label_dist").alias("metric"),
        F.col("n").cast("double").alias("value"),
        F.col("value").alias("text"),
    )


def _last_scores(history: DataFrame, strategy: str) -> DataFrame:
    """Scores after the last iteration of a strategy, in one row."""
    return history.where(F.col("strategy") == strategy).agg(
        *[F.max_by(c, "iteration").alias(c) for c in ("accuracy", "f1", "n_labeled")]
    )


def run_metrics(
    stages: Stages, id_col: str = ROW_ID, history: DataFrame | None = None, strategy: str = "entropy"
) -> DataFrame:
    """What each step took in and gave out: (step, metric, value, text).

    Every table is scanned once at most; the figures meet in a single row. With a learning
    ``history``, the train step's scores and savings follow.
    """
    raw_cols = content_columns(stages.raw, id_col)
    fixed, relabeled = stages.corrections, stages.al_corrections
    figures = _one_row(
        content_totals(stages.raw, raw_cols),
        stages.count("n_clean"),
        label_summary(stages.labeled, stages.threshold),
        stages.count("n_valid"),
        stages.count("n_final"),
        *([] if fixed is None else [_counted(fixed, "fixed")]),
        *([] if relabeled is None else [_counted(relabeled, "relabeled")]),
    )
    low, valid = F.col("low_confidence"), F.col("n_valid")
    merged = F.lit(0) if fixed is None else F.col("fixed")
    enough = valid >= MIN_SELECTABLE
    seed = F.greatest(F.lit(10), F.floor(F.lit(0.6) * valid))
    chosen = F.when(enough, F.least(F.lit(stages.n_select), valid - seed)).otherwise(valid)
    review_action = F.when(low == 0, "auto_skipped").otherwise(
        "skipped" if fixed is None else "corrected"
    )
    entries = [
        *_values("collect", {"rows": F.col("rows"), "cols": F.lit(len(raw_cols))}),
        *_values("clean", {"rows_before": F.col("rows"), "rows_after": F.col("n_clean"),
                           "duplicates_removed": F.col("duplicates")}),
        *[("clean", f"strategy_{k}", None, F.lit(v)) for k, v in (stages.strategy or {}).items()],
        ("clean_review", "action", None, F.lit("approved" if stages.approved else "skipped")),
        ("clean_review", "rows", F.col("n_clean"), None),
        *_values("annotate", {c: F.col(c) for c in (
            "total", "low_confidence", "errors", "confidence_mean")}),
        ("review", "action", None, review_action),
        *_values("review", {"low_conf": low, "corrected": F.when(low > 0, merged).otherwise(0)}),
        *_values("al_select", {
            "seed": F.when(enough, seed), "pool": F.when(enough, valid - seed),
            "selected": chosen, "total": F.when(enough, seed + chosen).otherwise(valid)}),
        ("al_select", "strategy", None, F.when(enough, strategy).otherwise("passthrough")),
        ("al_review", "action", None, F.lit("skipped" if relabeled is None else "corrected")),
        *_values("al_review", {
            "shown": F.col("n_final"),
            "corrected": F.lit(0) if relabeled is None else F.col("relabeled")}),
    ]
    found = _rows(figures, entries).unionByName(_label_dist(stages.labeled, "annotate"))
    if history is None:
        return found
    last, savings = _last_scores(history, strategy), sample_savings(history)
    return found.unionByName(
        _rows(last, _values("train", {c: F.col(c) for c in last.columns}))
    ).unionByName(_rows(savings, _values("train", {c: F.col(c) for c in savings.columns})))


def data_card(stages: Stages) -> DataFrame:
    """Row counts by stage and the label distribution: (step, metric, value, text)."""
    counts = _one_row(
        _counted(stages.raw, "raw"),
        stages.count("n_clean"),
        _counted(stages.labeled, "labeled"),
        stages.count("n_good"),
    )
    rows = _rows(counts, _values("card", {
        "raw": F.col("raw"), "clean": F.col("n_clean"), "labeled": F.col("labeled"), "final": F.col("n_good")}))
    return rows.unionByName(_label_dist(stages.labeled, "card"))


def final_metrics(stages: Stages, history: DataFrame, strategy: str = "entropy") -> DataFrame:
    """Stage figures, the last model scores, and the strategy comparison."""
    figures = _one_row(
        content_totals(stages.raw, content_columns(stages.raw)),
        stages.count("n_clean"),
        label_summary(stages.labeled, stages.threshold),
        stages.count("n_good"),
        stages.count("n_valid"),
    )
    valid = F.col("n_valid")
    seed = F.greatest(F.lit(10), F.floor(F.lit(0.6) * valid))
    chosen = F.when(valid >= MIN_SELECTABLE, F.least(F.lit(stages.n_select), valid - seed)).otherwise(valid)
    by_stage = _rows(figures, _values("stages", {
        "rows_collected": F.col("rows"), "duplicates_removed": F.col("duplicates"),
        "rows_clean": F.col("n_clean"), "rows_labeled": F.col("total"),
        "confidence_mean": F.round("confidence_mean", 3), "error_share": F.col("error_share"),
        "rows_selected": chosen, "rows_final": F.col("n_good")}))
    last = _last_scores(history, strategy)
    savings = sample_savings(history)
    return (
        by_stage.unionByName(_rows(last, _values("model", {c: F.col(c) for c in last.columns})))
        .unionByName(_rows(savings, _values("strategies", {c: F.col(c) for c in savings.columns})))
    )
