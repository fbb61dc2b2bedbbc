"""Connected components of a graph of links, by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.storage import stage


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after joining the components that ``links`` (a, b) connect.

    comp is the smallest node reachable; every node of a link must be in ``labels``.
    Each step is written to the shared folder, so lineage stays short and a lost
    executor costs one step. Links are contracted to components first: what is
    left shrinks with every step.
    """
    by = lambda side: labels.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    pairs = links.join(by("a"), "a").join(by("b"), "b").where("ca <> cb")
    pairs = stage(pairs.select(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).distinct(), "links")
    if pairs.isEmpty():
        return labels
    both = pairs.select("x", "y").union(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    tops = stage(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low"))
                 .select("node", F.least("node", "low").alias("comp")), "tops")
    while True:
        own = tops.select(F.col("node").alias("x"), F.col("comp").alias("cx"))
        heard = both.select(F.col("x").alias("node"), F.col("y").alias("x")).join(own, "x").groupBy("node").agg(F.min("cx").alias("near"))
        jump = tops.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = tops.join(heard, "node").join(jump, "comp").select("node", F.least("comp", "near", "far").alias("low"), "comp")
        new = stage(new, "tops")
        done = new.where("low <> comp").isEmpty()
        tops = new.select("node", F.col("low").alias("comp"))
        if done:
            break
    moved = tops.select(F.col("node").alias("comp"), F.col("comp").alias("low"))
    return stage(labels.join(moved, "comp", "left").select("node", F.coalesce("low", "comp").alias("comp")), "labels")
