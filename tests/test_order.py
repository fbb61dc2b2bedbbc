"""Order, splits, top-k, catalogue, column names, sources."""

import hashlib

import pytest
from pyspark.sql import functions as F

from labelmill.operators import catalog, order, schema
from labelmill.sources import sinks, tables
from labelmill.storage import CHECKPOINT_KEY, shared_folder


def shuffled(ids, seed=42):
    def key(i):
        return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], i

    return sorted(ids, key=key)


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") % 7).alias("v"))


def test_shuffle_split_and_sample_follow_one_order(table):
    expected = shuffled(range(2000))
    placed = order.seeded_shuffle(table).orderBy("position").collect()
    assert [r["row_id"] for r in placed] == expected
    assert [r["position"] for r in placed] == list(range(2000))
    parts = order.split_by_rank(table, {"a": 300, "b": 1, "c": 0, "d": None}).collect()
    found = {p: {r["row_id"] for r in parts if r["part"] == p} for p in "abcd"}
    assert found == {
        "a": set(expected[:300]), "b": {expected[300]}, "c": set(), "d": set(expected[301:]),
    }
    few = {r["row_id"] for r in order.sample_k(table, 5).collect()}
    many = {r["row_id"] for r in order.sample_k(table, 1500).collect()}
    assert few == set(expected[:5]) and many == set(expected[:1500])
    assert order.sample_k(table, 5000).count() == 2000


def test_head(table):
    assert [r["row_id"] for r in order.head_rows(table, 3).collect()] == [0, 1, 2]
    assert order.head_rows(table, 1200).count() == 1200


@pytest.mark.parametrize("n", [0, 10, 49, 80, 100, 399, 1000])
def test_sizes_by_hand(n):
    n_test = max(50, int(0.2 * n))
    rest = max(n - n_test, 0)
    start = min(50, int(0.5 * rest))
    assert order.learning_sizes(n) == {"labeled": start, "pool": rest - start, "test": None}
    assert order.seed_pool_sizes(n)["seed"] == min(n, max(10, int(0.6 * n)))
    sizes, batch = order.adaptive_sizes(n)
    assert batch >= 1 and min(sizes["labeled"], sizes["pool"]) >= 0
    if n == 100:
        assert (sizes, batch) == ({"labeled": 15, "pool": 65, "test": None}, 5)


def test_published_run_sizes():
    # 80 rows: 50 test, 15 labelled, 15 in the pool.
    assert order.learning_sizes(80, n_start=20) == {"labeled": 15, "pool": 15, "test": None}


def test_top_k_of_a_hot_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
        F.col("id").alias("pos"),
    )
    usual = order.top_k_per_group(df, ["g"], ["pos"], 40)
    order.LOCAL_LIMIT, limit = 1, order.LOCAL_LIMIT
    salted = order.top_k_per_group(df, ["g"], ["pos"], 40)
    order.LOCAL_LIMIT = limit
    assert usual.exceptAll(salted).count() == 0 == salted.exceptAll(usual).count()
    assert usual.groupBy("g").count().agg(F.max("count")).first()[0] == 40


def test_concat_fills_absent_columns(spark, table):
    other = spark.createDataFrame([(9, "x")], "row_id long, w string")
    both = order.concat_tables(table, other)
    assert both.columns == ["row_id", "v", "w"] and both.where("v IS NULL").count() == 1


HITS = [
    (0, 0, "Kaggle", "a/one", "IMDB reviews", None),
    (1, 0, "HuggingFace", "b/two", "weather", "temperatures"),
    (2, 0, "HuggingFace", "b/three", "Big Sentiment set", ""),
    (3, 1, "Kaggle", "a/one", "later title", "a corpus"),
    (4, 1, "HuggingFace", "b/four", None, "Tweet dump"),
    (5, 1, "Kaggle", "a/five", "Photos", "cats"),
]


@pytest.fixture(scope="module")
def hits(spark):
    return spark.createDataFrame(
        HITS, "pos long, query_id int, source string, ref string, title string, description string"
    )


def test_catalogue(hits):
    made = catalog.build_catalog(hits).orderBy("pos").collect()
    assert [r["ref"] for r in made] == ["a/one", "b/three", "b/four"]
    assert made[0]["url"] == "https://www.kaggle.com/datasets/a/one"
    assert made[1]["url"] == "https://huggingface.co/datasets/b/three"
    assert made[0]["description"] == "" and made[0]["size_mb"] == ""
    assert [r["ref"] for r in catalog.build_catalog(hits, n=1).collect()] == ["a/one"]
    assert catalog.build_catalog(hits, per_query=1).count() == 2


def test_preferred_record(hits):
    assert catalog.pick_preferred(hits).first()["ref"] == "b/three"
    assert catalog.pick_preferred(hits, pattern="nothing").first()["ref"] == "b/two"
    assert catalog.pick_preferred(hits, source="none").count() == 0


def test_queries_of_a_reply(spark):
    reply = "- movie reviews\n\n  \n* tweets -\r\n---\nplain \x85   last"
    expected = ["movie reviews", "* tweets", "", "plain", "last"]
    df = spark.createDataFrame([(1, reply)], "id int, reply string")
    assert [r["query"] for r in catalog.split_queries(df).orderBy("line").collect()] == expected


def test_column_names(spark):
    def named(*cols):
        return schema.normalize_columns(spark.createDataFrame([("a",) * len(cols)], list(cols)))

    assert named("Review", "SENTIMENT").columns == ["text", "original_label"]
    assert named("text", "review", "label").columns == ["text", "review", "original_label"]
    assert named("comment", "tweet", "class", "label").columns == [
        "text", "tweet", "original_label", "label",
    ]
    assert named("x", "original_label", "label").columns == ["x", "original_label", "label"]
    assert named("Text", "review").columns == ["text", "review"]
    assert named("Text", "Sentiment", "Original_Label").columns == ["text", "Sentiment", "original_label"]
    df = spark.createDataFrame([("a", "b")], ["Text", "Label"])
    assert schema.resolve_text(df) == "Text" and schema.resolve_label(df) == "Label"
    df = spark.createDataFrame([("a", "b")], ["x", "content"])
    assert schema.resolve_text(df) == "content" and schema.resolve_label(df) is None
    assert schema.resolve_text(df.select("x")) == "x"


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    df = spark.createDataFrame(
        [(1, 'a "quoted", text\nsecond line\r\nthird', 1.5), (2, " spaces ", None), (3, None, 2.0)],
        "row_id long, text string, x double",
    )
    sinks.write_table(df, path, "csv")
    assert sorted(map(str, tables.read_table(spark, path, df.schema.simpleString()[7:-1].replace(":", " "), multiline=True).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError, match="multiline"):
        tables.read_table(spark, path)
    inferred = tables.read_table(spark, path, multiline=True)
    assert dict(inferred.dtypes) == {"row_id": "int", "text": "string", "x": "double"}


def test_read_options(spark, sf_dir, tmp_path):
    path = f"{sf_dir}/labels.parquet"
    spread = tables.read_table(spark, path, spread_by="doc_id")
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread.exceptAll(tables.read_table(spark, path)).count() == 0
    lines = str(tmp_path / "lines.csv")
    sinks.write_table(spark.createDataFrame([(1, "a, b"), (2, "c")], "i int, s string"), lines, "csv")
    back = tables.read_table(spark, lines, "i int, s string", multiline=False)
    assert {tuple(r) for r in back.collect()} == {(1, "a, b"), (2, "c")}
    rows = str(tmp_path / "rows.json")
    sinks.write_table(spark.createDataFrame([(1, float("nan"))], "i int, x double"), rows, "json")
    assert tables.read_table(spark, rows, "i int, x double").first()["x"] is None


def test_first_usable_source(spark, tmp_path):
    def put(name, rows, cols):
        path = str(tmp_path / f"{name}.csv")
        sinks.write_table(spark.createDataFrame(rows, cols), path, "csv")
        return path

    few = put("few", [("t", "a")] * 10, ["text", "label_auto"])
    errors = put("errors", [("t", "a")] * 10 + [("t", "error")] * 9, ["text", "label_auto"])
    unlabelled = put("unlabelled", [("t", "a")] * 20, ["text", "other"])
    good = put("good", [("t", "a")] * 11, ["review", "label_auto"])
    paths = [str(tmp_path / "absent.csv"), few, errors, unlabelled, good]
    assert tables.first_usable_source(spark, paths, multiline=True).columns == ["text", "label_auto"]
    assert tables.first_usable_source(spark, paths[:-1], multiline=True) is None


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get(CHECKPOINT_KEY)
    assert shared_folder(spark) == f"{folder}/{spark.sparkContext.applicationId}"
