"""Profile and cleaning: known facts, missing-value rules, properties, edges."""

import pytest
from pyspark.sql import functions as F

from labelmill.functions.columns import nan_to_null
from labelmill.operators import clean, profile
from labelmill.operators.clean import DEFAULT_STRATEGY
from labelmill.plans.queries import view


@pytest.fixture(scope="module")
def dirty(spark, sf_dir):
    """Reviews with every tenth row repeated under a new id."""
    reviews = view(spark, sf_dir, "reviews")
    again = reviews.where("row_id % 10 = 0").withColumn("row_id", F.col("row_id") + 1000000)
    return reviews.unionByName(again).cache()


def rows(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_known_profile(dirty):
    assert rows(profile.missing_counts(dirty), "column", "missing") == {
        "quality": 669, "toxic": 669, "original_label": 669,
    }
    assert profile.duplicate_count(dirty).first()[0] == 101
    assert rows(profile.outlier_counts(dirty), "column", "outliers") == {
        "n_chars": 106, "quality": 66, "toxic": 55,
    }
    shape = profile.table_shape(dirty).first()
    assert (shape["rows"], shape["cols"]) == (1100, 7)
    assert (shape["missing_cells"], shape["outlier_cells"]) == (3 * 669, 106 + 66 + 55)


def test_known_cleaning(dirty):
    cleaned = clean.clean(dirty)
    after = rows(profile.compare_tables(dirty, cleaned), "metric", "after")
    assert after == {"Rows": 999, "Missing values": 600, "Duplicate rows": 0}
    assert cleaned.agg(F.sum("n_chars")).first()[0] == 2019564.25
    removed = clean.clean(dirty, {**DEFAULT_STRATEGY, "outliers": "remove"})
    assert removed.count() == 812


def test_narrowed_bounds_clean_alike(dirty):
    usual = clean.clean(dirty)
    narrowed = clean.clean(dirty, bracket_rows=20)
    assert usual.exceptAll(narrowed).count() == 0 == narrowed.exceptAll(usual).count()


def test_cleaning_properties(dirty):
    once = clean.drop_duplicates(dirty)
    assert clean.drop_duplicates(once).count() == once.count()
    assert profile.duplicate_count(once).first()[0] == 0
    lo, hi = profile.bounds_of(dirty, ["n_chars"])["n_chars"][2:]
    low, high = clean.clip_iqr(dirty, ["n_chars"]).agg(F.min("n_chars"), F.max("n_chars")).first()
    assert lo <= low and high <= hi
    assert clean.impute_mean(dirty).where("quality IS NULL").count() == 0


def test_duplicates_are_counted_as_they_are_dropped(spark):
    rows = [(i, f"2024-01-01 00:00:00.00000{i % 3}", bytes([i % 2]), [f"2024-01-01 00:00:00.00000{i % 2}"], 0.0 if i % 4 else -0.0) for i in range(24)]
    df = spark.createDataFrame(rows, "row_id long, t string, b binary, ts array<string>, x double")
    df = df.selectExpr("row_id", "timestamp(t) AS t", "CAST(t AS TIMESTAMP_NTZ) AS n", "b", "transform(ts, v -> timestamp(v)) AS ts", "x", "struct(timestamp(t) AS inner) AS s", "CAST(x AS DECIMAL(5, 2)) AS d", "date(t) AS day")
    kept = clean.drop_duplicates(df).count()
    assert kept == 6 and profile.duplicate_count(df).first()[0] == df.count() - kept
    assert clean.drop_duplicates(df, ["b"]).count() == 2
    assert {r["row_id"] for r in clean.drop_duplicates(df, ["b"]).collect()} == {0, 1}


def test_nan_is_cleaned_like_null(spark):
    values = [float(i) for i in range(20)]
    bad = {"nan": [*values, *[float("nan")] * 10], "null": [*values, *[None] * 10]}
    got = {}
    for kind, column in bad.items():
        df = spark.createDataFrame(list(enumerate(column)), "row_id long, x double")
        got[kind] = [rows(f(df), *c) for f, c in (
            (profile.missing_counts, ("column", "missing")), (profile.iqr_bounds, ("column", "q3")),
            (clean.column_fill_values, ("column", "fill")), (clean.clean, ("row_id", "x")),
            (profile.table_shape, ("rows", "missing_cells")), (clean.drop_missing, ("row_id", "x")),
        )]
    assert got["nan"] == got["null"] and got["nan"][0] == {"x": 10}


def test_unknown_strategy_is_a_no_op(dirty):
    same = clean.clean(dirty, {"missing": "?", "duplicates": "?", "outliers": "?"})
    assert same.exceptAll(dirty).count() == 0 and same.count() == dirty.count()


def test_default_steps_of_an_empty_strategy(dirty):
    # Missing and outlier steps default to median and clip; duplicates stay.
    assert clean.clean(dirty, {}).count() == dirty.count()
    assert clean.clean(dirty, {}).where("toxic IS NULL").count() == 0


def test_missing_value_rules(spark):
    df = nan_to_null(
        spark.createDataFrame(
            [(0, 1.0, "a"), (1, 2.0, ""), (2, float("nan"), None), (3, None, None), (4, 0.0, "a"),
             (5, -0.0, "a")],
            "row_id long, x double, s string",
        )
    )
    assert rows(profile.missing_counts(df), "column", "missing") == {"x": 2, "s": 2}
    # Two empty rows are equal, and so are 0.0 and -0.0; '' is not a missing text.
    assert profile.duplicate_count(df).first()[0] == 2
    assert clean.drop_duplicates(df).count() == 4
    assert rows(clean.column_fill_values(df), "column", "fill") == {"x": 0.5}
    assert rows(profile.value_counts(df, "s"), "value", "n") == {"a": 3, "": 1}


def test_column_without_values(spark):
    df = spark.createDataFrame([(0, None, "a"), (1, None, "b")], "row_id long, x double, s string")
    assert clean.impute_median(df).where("x IS NULL").count() == 2
    assert clean.clip_iqr(df).where("x IS NULL").count() == 2
    assert clean.remove_outliers(df).count() == 0
    assert profile.iqr_bounds(df).first()["q1"] is None
    assert clean.clean(df).count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, x double, s string")
    assert profile.missing_counts(df).count() == 0
    assert profile.duplicate_count(df).first()[0] == 0
    assert profile.top_categories(df).count() == 0
    assert profile.class_imbalance(df).count() == 0
    assert clean.clean(df).count() == 0
    report = profile.quality_report(df, clean.clean(df), DEFAULT_STRATEGY)
    assert report.where("section = 'shape' AND metric = 'rows'").first()["value"] == 0


def test_imbalance_lists_all_shares(spark):
    df = spark.createDataFrame(
        [(i, "x" if i < 9 else "y", "a" if i < 8 else "b") for i in range(10)] + [(10, None, None)],
        "row_id long, s string, t string",
    )
    found = {(r["column"], r["value"]): r["share"] for r in profile.class_imbalance(df).collect()}
    assert found == {("s", "x"): 0.9, ("s", "y"): 0.1}  # 0.8 is not above 0.8


def test_common_values_break_ties_beyond_the_start(spark):
    long = "same beginning of every one of the texts "
    texts = [long + str(i) for i in range(30)] * 2 + [long + "top"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, s string")
    expected = [(long + "top", 3)] + [(t, 2) for t in sorted(long + str(i) for i in range(30))[:9]]
    for limit in (profile.CANDIDATES, 0):  # broadcast candidates, joined candidates
        profile.CANDIDATES, usual = limit, profile.CANDIDATES
        top = profile.top_categories(df).orderBy("position").collect()
        profile.CANDIDATES = usual
        assert [(r["value"], r["n"]) for r in top] == expected
    assert top[1]["bar"] == 220 * 2 // 3


def test_first_copy_is_kept_with_its_other_columns(spark):
    df = spark.createDataFrame(
        [(3, "a", "third"), (1, "a", "first"), (2, "b", "only")], "row_id long, s string, o string"
    )
    kept = {tuple(r) for r in clean.drop_duplicates(df, ["s"]).collect()}
    assert kept == {(1, "a", "first"), (2, "b", "only")}


def test_remove_depends_on_column_order(spark):
    # Fences of the second column are taken from what the first left.
    df = spark.createDataFrame(
        [(i, float(i % 7) if i != 40 else 900.0, float(i % 5) if i != 41 else 800.0)
         for i in range(50)],
        "row_id long, x double, y double",
    )
    left = clean.remove_outliers(df, ["x", "y"])
    assert {r["row_id"] for r in left.collect()} == set(range(50)) - {40, 41}


def test_approximate_cleaning(dirty):
    cleaned = clean.clean(dirty, method="approx")
    assert abs(cleaned.count() - 999) <= 1
    assert cleaned.where("toxic IS NULL").count() == 0


def test_strategies_one_by_one(dirty):
    kept = clean.clean(dirty, {"missing": "drop", "outliers": "none"})
    assert kept.count() == 1100 - 669
    filled = clean.clean(dirty, {"missing": "mean", "outliers": "none"})
    mean = dirty.agg(F.avg("toxic")).first()[0]
    assert {r[0] for r in filled.select("toxic").distinct().collect()} == {0.0, 1.0, mean}
