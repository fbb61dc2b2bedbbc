"""Exact rank selection against sorted lists, skew and ties included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.functions import ranks
from labelmill.functions.columns import seeded_key


def numbers(kind):
    rng = random.Random(kind)
    if kind == "spread":
        return [rng.uniform(-1e6, 1e6) for _ in range(4000)]
    if kind == "hot":  # a third of all rows hold one value
        return [7.0] * 1500 + [rng.gauss(7, 3) for _ in range(3000)]
    if kind == "two":
        return [0.0] * 2000 + [1.0] * 2001
    if kind == "nulls":
        return [None if i % 3 == 0 else rng.expovariate(1) for i in range(3000)]
    return [float(i % 50) for i in range(5000)]


@pytest.mark.parametrize("kind", ["spread", "hot", "two", "nulls", "steps"])
def test_order_statistics(spark, kind):
    values = numbers(kind)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    present = sorted(v for v in values if v is not None)
    n = len(present)
    wanted = [0, 1, n // 4, n // 2, n - 2, n - 1]
    found = ranks.order_statistics(df, {"x": [*wanted, n + 5]}, bracket_rows=20)
    assert ("x", n + 5) not in found
    for r in wanted:
        hit = found["x", r]
        assert hit.value == present[r]
        assert hit.below == sum(v < present[r] for v in present)
        assert hit.equal == present.count(present[r])


@pytest.mark.parametrize("kind", ["spread", "hot", "two", "nulls", "steps"])
def test_quantiles_narrowed_equal_direct(spark, kind):
    values = numbers(kind)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    fractions = [0.25, 0.5, 0.75, 0.999]
    expected = np.quantile([v for v in values if v is not None], fractions)
    direct = ranks.quantiles(df, ["x"], fractions)["x"]
    for rows in (1, 20, 700, 10**6):  # bit for bit, however far the search has to go
        assert ranks.quantiles(df, ["x"], fractions, bracket_rows=rows)["x"] == direct
    assert direct == pytest.approx(list(expected), rel=1e-12, abs=1e-12)


def test_nan_is_missing(spark):
    values = [float(i % 7) for i in range(50)]
    df = spark.createDataFrame([(v,) for v in [*values, *[float("nan")] * 25, None]], "x double")
    assert ranks.quantiles(df, ["x"], [0.25, 0.75])["x"] == list(np.quantile(values, [0.25, 0.75]))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert ranks.quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert ranks.quantiles(df, ["x"], [0.5], method="approx") == {"x": [None]}


def test_approximate_quantiles(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    low, high = ranks.quantiles(df, ["x"], [0.25, 0.75], method="approx")["x"]
    assert abs(low - 2500) <= 2 and abs(high - 7500) <= 2


@pytest.mark.parametrize("k", [0, 1, 700, 999, 1000, 1001, 1500, 2000, 2001, 2500, 3999, 4000, 9000])
def test_first_k_equals_sorted_limit(spark, k):
    # Scores tie for many rows, a quarter is null and a quarter NaN: these come last.
    df = spark.range(4000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 4 == 0, F.lit(None).cast("double"))
        .when(F.col("id") % 4 == 1, F.lit(float("nan")))
        .when(F.col("id") % 3 == 0, 0.5)
        .otherwise((F.col("id") * 37 % 101) / 100).alias("s"),
    )
    score = F.nanvl("s", F.lit(None).cast("double"))
    limit = df.orderBy((-score).asc_nulls_last(), "row_id").limit(k)
    ids = [sorted(r["row_id"] for r in x.select("row_id").collect())
           for x in (ranks.first_k(df, -F.col("s"), k, bracket_rows=50), limit)]
    assert ids[0] == ids[1]
    assert len(ids[0]) == min(k, 4000)


@pytest.mark.parametrize("k", [0, 1, 9, 10, 11, 60, 299, 300, 400])
def test_commonest_equals_sorted_limit(spark, k):
    words = [f"common prefix {i}" if i % 2 else f"w{i:03d}é" for i in range(300)]
    df = spark.createDataFrame([(w, 10 if i < 10 else i % 3) for i, w in enumerate(words)], "t string, n long")
    got = {r["t"] for r in ranks.commonest(df, "n", "t", k, bracket_rows=5).collect()}
    assert got == {r["t"] for r in df.orderBy(F.desc("n"), "t").limit(k).collect()}


def test_rank_conditions_with_many_passes(spark):
    df = spark.range(3000).withColumnRenamed("id", "row_id").withColumn(
        "key", seeded_key("row_id", 42)
    )
    sizes = [0, 10, 1777, 3000, 5000]
    conditions = ranks.rank_conditions(df, "key", "row_id", sizes, bracket_rows=20)
    assert [df.where(c).count() for c in conditions] == [0, 10, 1777, 3000, 3000]
    first = [r["row_id"] for r in df.orderBy("key", "row_id").limit(1777).collect()]
    assert sorted(first) == sorted(r["row_id"] for r in df.where(conditions[2]).collect())
