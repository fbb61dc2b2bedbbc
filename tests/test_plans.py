"""Physical plans: what must and must not be in them."""

import contextlib
import io
import re

import pytest

from labelmill.operators import clean, features, order, profile
from labelmill.plans.queries import QUERIES, view
from labelmill.sources.tables import read_table

# Offsets of at most 65,536 buckets are summed in one task.
BOUNDED_WINDOW = {"seeded_shuffle"}
MODELS = {
    "fit_classifier", "predict", "evaluate", "save_model", "al_cycle", "compare_strategies",
    "select_informative", "curation_flow",
}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_python_no_cartesian_no_global_window_no_long_limit(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    assert "CartesianProduct" not in text
    limits = re.findall(r"(?:TakeOrderedAndProject|CollectLimit)\D*?limit=(\d+)", text)
    assert all(int(n) <= 1000 for n in limits)
    lines = text.splitlines()
    for above, below, further in zip(lines, lines[1:], lines[2:]):
        if re.search(r"\bWindow \[", above) and name not in BOUNDED_WINDOW:
            assert "SinglePartition" not in below + further


def test_row_maps_do_not_shuffle(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "row_id")
    vocabulary = features.tfidf_fit(rows)
    assert "Exchange" not in plan(features.tfidf_transform(rows, vocabulary))
    assert "Exchange" not in plan(order.split_by_rank(rows, {"a": 10, "b": None}))


def test_split_and_shuffle_read_the_id_alone(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "row_id")
    text = plan(order.split_by_rank(rows, {"a": 10, "b": None}).select("row_id", "part"))
    assert re.search(r"ReadSchema: struct<doc_id:bigint>\n", text)


def test_parts_of_the_vectors_are_pruned(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("doc_id", "row_id")
    parts = order.split_by_rank(rows, {"labeled": 10, "pool": None})
    vocabulary = features.tfidf_fit(rows, max_features=50)
    sparse = features.tfidf_transform(parts, vocabulary, keep=["part"])
    vectors = features.stage_vectors(sparse, 50, "part")
    few = vectors.where("part = 'labeled'")
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = labeled", plan(few))
    assert few.count() == 10 and vectors.count() == rows.count()


def test_profiles_read_what_they_use(spark, sf_dir):
    lineitem = read_table(spark, f"{sf_dir}/lineitem.parquet")
    text = plan(profile.value_counts(lineitem, "l_returnflag"))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"l_returnflag:string"}


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["take_rows"](spark, sf_dir))
    assert "EqualTo(toxic,1)" in text.replace("1.0", "1")


def test_hot_groups_are_cut_before_the_shuffle(spark, sf_dir):
    for name in ("top_k_per_group", "dedup_by_key", "build_catalog"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert re.search(r"WindowGroupLimit .* Partial", text), name


def test_dedup_is_one_shuffle_with_a_combine(spark, sf_dir):
    text = plan(clean.drop_duplicates(view(spark, sf_dir, "dirty_reviews")))
    assert text.count("Exchange hashpartitioning(text") == 1
    assert "partial_min(row_id" in text


def test_first_rows_are_filters(spark, sf_dir):
    for name in ("head_rows", "sample_k", "query_pool_entropy"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "TakeOrdered" not in text and "Sort" not in text.replace("SortMergeJoin", ""), name
