"""The whole flow: clean, label, review, select, train, report."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions.columns import LABEL, ROW_ID
from labelmill.operators.active import Comparison, compare_strategies, select_informative
from labelmill.operators.annotate import Annotated, Labeler, annotate
from labelmill.operators.clean import DEFAULT_STRATEGY, clean
from labelmill.operators.filters import (
    LOW_CONFIDENCE,
    drop_error_labels,
    filter_low_confidence,
    filter_valid_labels,
    valid_label,
)
from labelmill.operators.profile import quality_report
from labelmill.operators.report import Stages, counts_of, data_card, final_metrics, run_metrics
from labelmill.operators.review import apply_corrections, replace_with_reviewed, review_queue
from labelmill.operators.schema import normalize_columns, resolve_label, resolve_text
from labelmill.storage import stage, stage_counted


@dataclass
class Curated:
    """Everything a run yields; stage tables are written, reports are lazy."""

    stages: Stages
    quality: DataFrame
    annotated: Annotated
    queue: DataFrame
    selected: DataFrame
    comparison: Comparison
    metrics: DataFrame
    card: DataFrame
    report: DataFrame
    dataset: DataFrame


def curation_flow(
    df: DataFrame,
    labeler: Labeler,
    corrections: DataFrame | None = None,
    reviewed: DataFrame | None = None,
    strategy: Mapping[str, str] = DEFAULT_STRATEGY,
    threshold: float = LOW_CONFIDENCE,
    n_label: int | None = None,
    n_select: int = 50,
    n_iterations: int = 5,
    batch_size: int = 10,
    correction_mode: str = "upsert",
    approved: bool = False,
    id_col: str = ROW_ID,
    **fit,
) -> Curated:
    """Run every step; a reviewer's decisions arrive as tables, None skips a review.

    ``approved`` says that a reviewer approved the cleaned table.

    Each stage table is written once to the shared folder, its rows are counted while
    they are written, and everything after reads it from there.
    """
    spark = df.sparkSession
    # Read more than ten times, mostly for its numbers: the input's joins and texts are not gone through again.
    raw = stage(normalize_columns(df), "raw")
    text, human = resolve_text(raw), resolve_label(raw)
    cleaned, counts = stage_counted(clean(raw, strategy, id_col=id_col), "clean", **counts_of("clean"))
    annotated = annotate(cleaned, labeler, text, human, n=n_label, id_col=id_col)
    labeled = annotated.labeled
    merged = labeled
    # Without a row to review, the queue is empty and corrections are not asked for.
    if corrections is not None and not filter_low_confidence(labeled, threshold).isEmpty():
        merged, seen = stage_counted(
            apply_corrections(labeled, corrections, threshold, correction_mode, id_col), "merged", **counts_of("reviewed")
        )
        counts |= seen
    of_final = counts_of("final") | {"usable": F.count_if(valid_label())}
    selected, seen = stage_counted(
        select_informative(merged, n_select, text, LABEL, id_col, **fit), "selected", **of_final
    )
    final = selected
    if reviewed is not None:
        final, seen = stage_counted(replace_with_reviewed(selected, reviewed), "final", **of_final)
    counts |= seen

    @inheritable_thread_target(spark)
    def profiled() -> DataFrame:
        return quality_report(raw, cleaned, dict(strategy), id_col)

    # The profile needs the first two tables only, and small fits leave most cores idle.
    with ThreadPoolExecutor(max_workers=1) as threads:
        quality = threads.submit(profiled)
        comparison = compare_strategies(
            filter_valid_labels(final),
            n_start=min(20, max(5, counts["usable"] // 4)),
            n_iterations=n_iterations, batch_size=batch_size,
            text=text, label=LABEL, id_col=id_col, **fit,
        )
    stages = Stages(
        raw, cleaned, labeled, merged, final, corrections, reviewed, threshold, n_select,
        dict(strategy), approved, counts,
    )
    return Curated(
        stages=stages,
        quality=quality.result(),
        annotated=annotated,
        queue=review_queue(filter_low_confidence(labeled, threshold), id_col),
        selected=selected,
        comparison=comparison,
        metrics=run_metrics(stages, id_col, comparison.history),
        card=data_card(stages),
        report=final_metrics(stages, comparison.history),
        dataset=drop_error_labels(final),
    )
