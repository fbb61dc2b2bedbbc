"""Registered queries: one per operator, each over whole given tables.

Double columns are rounded to six digits so that engines compare alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions.columns import truncate_text
from labelmill.operators import (
    active,
    annotate,
    catalog,
    clean,
    features,
    filters,
    history,
    learn,
    order,
    profile,
    report,
    review,
    schema,
)
from labelmill.plans.flow import curation_flow
from labelmill.plans.views import with_views
from labelmill.sources import sinks, tables
from labelmill.storage import new_stage_path, stage, stage_counted

Query = Callable[[SparkSession, str], DataFrame]

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
#: How a time is shown, so that engines compare alike.
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
HUBS = {"HubA": "https://a.example/", "HubB": "https://b.example/"}
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view of ``labelmill.plans.views`` over the tables of ``sf_dir``."""
    bases = {
        base: tables.read_table(spark, f"{sf_dir}/{base}.parquet", spread_by=key)
        for base, key in (("documents", "doc_id"), ("labels", None), ("pages", None))
    }
    # the tables go in as arguments, no temp view of the session is replaced
    ctes = "".join(f"{base} AS (SELECT * FROM {{lm_{base}}}), " for base in bases)
    views = with_views([name]).replace("{", "{{").replace("}", "}}")
    sql = f"WITH {ctes}{views} SELECT * FROM {name}"
    return spark.sql(sql, **{f"lm_{base}": df for base, df in bases.items()})


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def query(name: str, base: str | None = None) -> Callable:
    """Register ``fn(df)`` over a view, or ``fn(spark, sf_dir)`` without one."""

    def register(fn: Callable) -> Callable:
        if base is None:
            QUERIES[name] = lambda spark, sf: rounded(fn(spark, sf))
        else:
            QUERIES[name] = lambda spark, sf: rounded(fn(view(spark, sf, base)))
        return fn

    return register


# --- sources and sinks ---


@query("read_table")
def _(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.date_format("ts", TIME))


@query("read_csv_table")
def _(spark, sf):
    path = new_stage_path(spark, "documents") + ".csv"
    documents = table(spark, sf, "documents")
    sinks.write_table(documents, path, "csv")
    return tables.read_table(
        spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint",
        multiline=True,
    )


@query("first_usable_source")
def _(spark, sf):
    candidates = [f"{sf}/{n}.parquet" for n in ("absent", "benchmark", "conversations")]
    return tables.first_usable_source(spark, candidates, label="role").select("text", "role")


@query("write_table", "labeled")
def _(df):
    path = new_stage_path(df.sparkSession, "labeled")
    sinks.write_table(df, path)
    return tables.read_table(df.sparkSession, path)


@query("write_table_json", "labeled")
def _(df):
    path = new_stage_path(df.sparkSession, "labeled") + ".json"
    sinks.write_table(df, path, "json")
    return tables.read_table(df.sparkSession, path, "row_id bigint, text string, human_label string, label_auto string, confidence double")


@query("export_review_queue", "labeled")
def _(df):
    path = new_stage_path(df.sparkSession, "queue")
    sinks.export_review_queue(filters.filter_low_confidence(df), path)
    return tables.read_corrections(df.sparkSession, path)


@query("read_corrections", "corrections")
def _(df):
    path = new_stage_path(df.sparkSession, "corrections")
    sinks.write_table(df, path, "csv")
    return tables.read_corrections(df.sparkSession, path)


def _flat_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.select(
        "id",
        F.col("data.text").alias("text"),
        F.explode_outer("predictions").alias("p"),
    ).select(
        "id", "text", "p.model_version", "p.score",
        F.element_at("p.result", 1).from_name.alias("from_name"),
        F.element_at("p.result", 1).to_name.alias("to_name"),
        F.element_at("p.result", 1).type.alias("type"),
        F.element_at(F.element_at("p.result", 1).value.choices, 1).alias("choice"),
    )


@query("write_tasks", "labeled")
def _(df):
    path = new_stage_path(df.sparkSession, "tasks")
    tasks = annotate.label_tasks(df)
    sinks.write_tasks(tasks, path)
    return _flat_tasks(df.sparkSession.read.schema(tasks.schema).json(path))


@query("write_metrics", "labeled")
def _(df):
    path = new_stage_path(df.sparkSession, "metrics")
    sinks.write_metrics(annotate.label_summary(df), path)
    return df.sparkSession.read.json(path).select(
        "total", "low_confidence", "errors", "confidence_mean", "error_share"
    )


# --- columns and filters ---


@query("normalize_columns")
def _(spark, sf):
    documents = table(spark, sf, "documents")
    return schema.normalize_columns(
        documents.select("doc_id", F.col("text").alias("Review"), F.col("lang").alias("Category"),
                         F.col("source").alias("class"), F.col("n_chars").alias("Text_Chars"))
    )


@query("resolve_columns")
def _(spark, sf):
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("sentiment"), F.col("text").alias("comment")
    )
    return turns.select(
        "conv_id", "turn", F.col(schema.resolve_text(turns)).alias("text"),
        F.col(schema.resolve_label(turns)).alias("label"),
    )


@query("truncate_text", "reviews")
def _(df):
    return df.select("row_id", truncate_text(F.col("text"), 400).alias("text"),
                     truncate_text(F.col("original_label"), 60).alias("original_label"))


@query("filter_text_datasets", "hits")
def _(df):
    return filters.filter_text_datasets(df)


@query("filter_low_confidence", "labeled")
def _(df):
    return filters.filter_low_confidence(df)


@query("filter_valid_labels", "labeled")
def _(df):
    return filters.filter_valid_labels(df)


@query("drop_error_labels", "labeled")
def _(df):
    return filters.drop_error_labels(df)


@query("drop_null_rows", "labeled")
def _(df):
    return filters.drop_null_rows(df, ["label_auto", "confidence"])


# --- keyed joins ---


def _toxic_ids(df: DataFrame) -> DataFrame:
    return df.where("toxic = 1").select("row_id")


@query("take_rows", "reviews")
def _(df):
    return review.take_rows(df, _toxic_ids(df))


@query("remove_rows", "reviews")
def _(df):
    return review.remove_rows(df, _toxic_ids(df))


@query("apply_corrections")
def _(spark, sf):
    return review.apply_corrections(view(spark, sf, "labeled"), view(spark, sf, "corrections"))


@query("apply_corrections_replace")
def _(spark, sf):
    return review.apply_corrections(
        view(spark, sf, "labeled"), view(spark, sf, "corrections"), mode="replace"
    )


@query("replace_with_reviewed_upsert")
def _(spark, sf):
    return review.replace_with_reviewed(
        view(spark, sf, "labeled"), view(spark, sf, "corrections"), mode="upsert"
    )


@query("replace_with_reviewed")
def _(spark, sf):
    return review.replace_with_reviewed(view(spark, sf, "labeled"), view(spark, sf, "corrections"))


# --- profile ---


@query("missing_counts", "dirty_reviews")
def _(df):
    return profile.missing_counts(df)


@query("duplicate_count", "dirty_reviews")
def _(df):
    return profile.duplicate_count(df)


@query("duplicate_count_times")
def _(spark, sf):
    """Events without their id, times included."""
    return profile.duplicate_count(table(spark, sf, "events").drop("event_id"))


@query("table_shape", "dirty_reviews")
def _(df):
    return profile.table_shape(df)


@query("iqr_bounds")
def _(spark, sf):
    return profile.iqr_bounds(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


@query("outlier_counts")
def _(spark, sf):
    events = profile.outlier_counts(table(spark, sf, "events"), ["value"])
    return events.unionByName(
        profile.outlier_counts(table(spark, sf, "documents"), ["n_chars"])
    ).unionByName(profile.outlier_counts(table(spark, sf, "customer"), ["c_acctbal"]))


@query("class_imbalance", "dirty_reviews")
def _(df):
    return profile.class_imbalance(df)


@query("value_counts")
def _(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@query("top_categories", "dirty_reviews")
def _(df):
    return profile.top_categories(df)


@query("column_fill_values", "reviews")
def _(df):
    medians = clean.column_fill_values(df, how="median")
    means = clean.column_fill_values(df, how="mean").withColumnRenamed("fill", "mean")
    return medians.withColumnRenamed("fill", "median").join(means, "column")


@query("compare_tables", "dirty_reviews")
def _(df):
    return profile.compare_tables(df, stage(clean.clean(df), "clean"))


@query("detect_issues", "dirty_reviews")
def _(df):
    return profile.detect_issues(df)


@query("build_strategy_prompt", "dirty_reviews")
def _(df):
    prompt = profile.build_strategy_prompt(profile.detect_issues(df), clean.DEFAULT_STRATEGY)
    found = F.from_json(
        F.regexp_extract("prompt", r"Findings: (\[.*\])\nSteps: ", 1),
        "array<struct<section string, key string, metric string, value double, text string>>",
    )
    return prompt.select(F.inline(found))


@query("quality_report", "dirty_reviews")
def _(df):
    return profile.quality_report(df, stage(clean.clean(df), "clean"), clean.DEFAULT_STRATEGY)


# --- cleaning ---


@query("impute_median", "dirty_reviews")
def _(df):
    return clean.impute_median(df)


@query("impute_mean", "dirty_reviews")
def _(df):
    return clean.impute_mean(df)


@query("drop_missing", "dirty_reviews")
def _(df):
    return clean.drop_missing(df)


@query("drop_duplicates", "dirty_reviews")
def _(df):
    return clean.drop_duplicates(df)


@query("clip_iqr")
def _(spark, sf):
    return clean.clip_iqr(table(spark, sf, "events"), ["value"]).withColumn("ts", F.date_format("ts", TIME))


@query("remove_outliers", "reviews")
def _(df):
    return clean.remove_outliers(df, ["n_chars", "quality", "toxic"])


@query("clean", "dirty_reviews")
def _(df):
    return clean.clean(df)


@query("clean_remove", "dirty_reviews")
def _(df):
    strategy = {"missing": "mean", "duplicates": "drop", "outliers": "remove"}
    return clean.clean(df, strategy, ["n_chars", "quality"])


@query("clean_remove_all", "dirty_reviews")
def _(df):
    return clean.clean(df, {"missing": "mean", "duplicates": "drop", "outliers": "remove"})


# --- order ---


@query("head_rows", "reviews")
def _(df):
    return order.head_rows(df, 100)


@query("seeded_shuffle", "reviews")
def _(df):
    return order.seeded_shuffle(df.select("row_id", "text"))


@query("sample_k", "reviews")
def _(df):
    return order.sample_k(df.where("original_label IS NOT NULL"), 10)


@query("split_by_rank", "reviews")
def _(df):
    rows = df.where("original_label IS NOT NULL").select("row_id", "original_label")
    return order.split_by_rank(rows, order.learning_sizes(rows.count()))


@query("part_sizes")
def _(spark, sf):
    """The sizes that the three rules give for each language's reviews."""
    rows = []
    for r in view(spark, sf, "reviews").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():  # a few languages
        adaptive, batch = order.adaptive_sizes(r["n"])
        rules = {"seed_pool": order.seed_pool_sizes(r["n"]), "learning": order.learning_sizes(r["n"]), "adaptive": adaptive | {"batch": batch}}
        rows += [(r["lang"], rule, part, size) for rule, sizes in rules.items() for part, size in sizes.items()]
    return spark.createDataFrame(rows, "lang string, rule string, part string, size bigint")


@query("top_k_per_group", "hits")
def _(df):
    return order.top_k_per_group(df, ["query_id", "source"], ["pos"])


@query("concat_tables")
def _(spark, sf):
    return order.concat_tables(
        view(spark, sf, "reviews").select("row_id", "text", "lang"),
        view(spark, sf, "corrections").withColumnRenamed("row_index", "row_id"),
    )


# --- catalogue ---


@query("catalog_records", "hits")
def _(df):
    return catalog.catalog_records(df, HUBS)


@query("dedup_by_key", "hits")
def _(df):
    return catalog.dedup_by_key(catalog.catalog_records(df, HUBS))


@query("limit_catalog", "hits")
def _(df):
    return catalog.limit_catalog(df)


@query("pick_preferred", "hits")
def _(df):
    return catalog.pick_preferred(df, "HubB")


@query("build_catalog", "hits")
def _(df):
    return catalog.build_catalog(df, HUBS)


@query("build_search_prompts")
def _(spark, sf):
    wishes = table(spark, sf, "benchmark").withColumnRenamed("text", "wish")
    both = catalog.build_search_prompts(wishes).withColumn("kind", F.lit("search"))
    return both.unionByName(
        catalog.build_translation_prompts(wishes).withColumn("kind", F.lit("translation"))
    )


@query("split_queries")
def _(spark, sf):
    bullets = F.concat(F.lit("- "), F.replace("text", F.lit("\n"), F.lit("\n- ")))
    return catalog.split_queries(
        table(spark, sf, "documents").select("doc_id", bullets.alias("reply"))
    )


# --- labelling ---


@query("build_label_prompts", "reviews")
def _(df):
    return annotate.build_label_prompts(df)


@query("parse_label_responses", "responses")
def _(df):
    return annotate.parse_label_responses(df)


@query("build_guide_prompt", "reviews")
def _(df):
    return annotate.build_guide_prompt(df)


@query("label_tasks", "labeled")
def _(df):
    return _flat_tasks(annotate.label_tasks(df))


@query("label_quality", "labeled")
def _(df):
    return annotate.label_quality(df, "human_label")


@query("label_summary", "labeled")
def _(df):
    return annotate.label_summary(df)


@query("auto_label")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    return annotate.auto_label(view(spark, sf, "reviews"), labeler)


@query("auto_label_strict")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    return annotate.auto_label(view(spark, sf, "reviews"), labeler, labels=("positive", "neutral"), strict=True)


@query("annotate_label_dist")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    return annotate.annotate(view(spark, sf, "reviews"), labeler, human="original_label").label_dist


@query("annotate")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    reviews = view(spark, sf, "reviews")
    return annotate.annotate(reviews, labeler, human="original_label").quality


@query("annotate_guide_prompt")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    return annotate.annotate(view(spark, sf, "reviews"), labeler, human="original_label").guide_prompt


@query("annotate_tasks")
def _(spark, sf):
    labeler = annotate.stored_replies(view(spark, sf, "responses"))
    return _flat_tasks(annotate.annotate(view(spark, sf, "reviews"), labeler, human="original_label").tasks)


@query("reply_store")
def _(spark, sf):
    """Labels of a function that is asked once for each distinct prompt; the second run asks nothing."""
    classes, path = annotate.CLASSES, new_stage_path(spark, "replies")

    def answer(prompt: str) -> str:
        n = len(prompt)
        return f'{{"label": "{classes[n % 3]}", "confidence": {n % 100 / 100}}}'

    labeler = annotate.reply_store(answer, path)
    for _run in range(2):
        labeled = annotate.auto_label(view(spark, sf, "dirty_reviews"), labeler)
    asked = annotate.stored_answers(spark, path).agg(F.count(F.lit(1))).scalar()
    return labeled.select("row_id", "label_auto", "confidence", asked.alias("asked"))


# --- features ---


@query("tokenize", "reviews")
def _(df):
    found = features.tokenize(df)
    return found.select(
        "row_id", F.size("terms").cast("bigint").alias("n_terms"),
        F.array_join("terms", " ").alias("terms"),
    )


@query("tfidf_fit", "reviews")
def _(df):
    return features.tfidf_fit(df)


@query("tfidf_transform", "reviews")
def _(df):
    vocabulary = features.tfidf_fit(df)
    return features.feature_table(features.tfidf_transform(df, vocabulary), vocabulary)


# --- scores and queries ---

def _probs():
    return F.array("p1", "p2", "p3")


@query("entropy_score", "probs")
def _(df):
    return df.select("row_id", active.entropy_score(_probs()).alias("score"))


@query("margin_score", "probs")
def _(df):
    return df.select("row_id", active.margin_score(_probs()).alias("score"))


@query("random_score", "probs")
def _(df):
    return df.select("row_id", active.random_score().alias("score"))


def _query_pool(strategy: str) -> Callable:
    return lambda df: active.query_pool(df.select("row_id", _probs().alias("probs")), strategy, 25)


for _name in ("entropy", "margin", "random"):
    query(f"query_pool_{_name}", "probs")(_query_pool(_name))


@query("query_pool_missing", "probs")
def _(df):
    """Every third row has no probabilities; more rows are asked for than have some."""
    probs = F.when(F.col("row_id") % 3 != 0, _probs())
    n = df.count()
    return active.query_pool(df.select("row_id", probs.alias("probs")), "margin", n - n // 5)


# --- metrics and histories ---


@query("classification_metrics", "predictions")
def _(df):
    return learn.classification_metrics(df)


@query("sample_savings", "history")
def _(df):
    return history.sample_savings(df)


@query("sample_savings_target", "history")
def _(df):
    return history.sample_savings(df, target=0.5)


@query("write_learning_report", "history")
def _(df):
    path = new_stage_path(df.sparkSession, "report")
    sinks.write_learning_report({"batch_size": 10}, df, history.sample_savings(df), path)
    found = df.sparkSession.read.json(path)
    rows = found.select("config.batch_size", F.inline("histories"))
    return rows.select("batch_size", "strategy", "iteration", "n_labeled", "accuracy", "f1")


@query("learning_curve_pivot", "history")
def _(df):
    return history.learning_curve_pivot(df)


@query("union_histories", "history")
def _(df):
    parts = {s: df.where(F.col("strategy") == s).drop("strategy") for s in active.STRATEGIES}
    return history.union_histories(parts)


def _stages(spark: SparkSession, sf: str) -> report.Stages:
    raw, labeled = view(spark, sf, "dirty_reviews"), view(spark, sf, "labeled")
    corrections = view(spark, sf, "corrections")
    merged, of_merged = stage_counted(
        review.apply_corrections(labeled, corrections), "merged",
        **report.counts_of("reviewed"), n_good=F.count_if(filters.no_error_label()),
    )
    cleaned, of_clean = stage_counted(clean.clean(raw), "clean", **report.counts_of("clean"))
    # the final table is the merged one without error labels: its rows are the good ones
    counts = of_merged | of_clean | {"n_final": of_merged["n_good"]}
    return report.Stages(
        raw, cleaned, labeled, merged, filters.drop_error_labels(merged), corrections,
        strategy=clean.DEFAULT_STRATEGY, approved=True, counts=counts,
    )


@query("run_metrics")
def _(spark, sf):
    return report.run_metrics(_stages(spark, sf), history=view(spark, sf, "history"))


@query("data_card")
def _(spark, sf):
    return report.data_card(_stages(spark, sf))


@query("final_metrics")
def _(spark, sf):
    return report.final_metrics(_stages(spark, sf), view(spark, sf, "history"))


# --- models (no SQL twin: an iterative fit) ---


def _vectors(df: DataFrame, label: str = "original_label") -> tuple[DataFrame, DataFrame]:
    """Staged vectors of the labelled reviews, and the vocabulary."""
    rows, seen = stage_counted(df.where(F.col(label).isNotNull()).select("row_id", "text", label), "rows", rows=F.count(F.lit(1)))
    parts = order.split_by_rank(rows, order.learning_sizes(seen["rows"]), total=seen["rows"])
    vocabulary = features.tfidf_fit(rows, n=seen["rows"])
    sparse = features.tfidf_transform(parts, vocabulary, keep=[label, "part"])
    return features.stage_vectors(sparse, vocabulary.count(), "part"), vocabulary


@query("fit_classifier", "reviews")
def _(df):
    vectors, vocabulary = _vectors(df)
    fitted = learn.fit_classifier(vectors, "original_label")
    return learn.coefficient_table(fitted, vocabulary)


def _shown(predicted: DataFrame, classes: list[str], *keep: str) -> DataFrame:
    """Prediction and the probability of each class, as columns p_<class>."""
    probs = [F.get("probs", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(classes)]
    return predicted.select("row_id", *keep, "prediction", *probs)


@query("predict", "reviews")
def _(df):
    vectors, _vocabulary = _vectors(df)
    fitted = learn.fit_classifier(vectors, "original_label")
    return _shown(learn.predict(fitted, vectors), fitted.classes, "original_label")


@query("fit_report", "reviews")
def _(df):
    """Steps, loss and gradient norm of the fit over all labelled reviews."""
    vectors, _vocabulary = _vectors(df)
    return learn.fit_report(learn.fit_classifier(vectors, "original_label"), vectors, "original_label")


@query("evaluate", "reviews")
def _(df):
    vectors, _vocabulary = _vectors(df)
    test = F.col("part") == "test"
    return learn.evaluate(vectors.where(~test), vectors.where(test), "original_label")


@query("save_model", "reviews")
def _(df):
    vectors, vocabulary = _vectors(df)
    path = new_stage_path(df.sparkSession, "model")
    sinks.save_model(learn.fit_classifier(vectors, "original_label"), vocabulary, path)
    loaded = sinks.load_model(df.sparkSession, path)
    return _shown(learn.predict(loaded.classifier, vectors), loaded.classifier.classes)


#: How far class centroids are stretched to serve as coefficients.
STRETCH = 8.0


def _centroids(vectors: DataFrame, size: int) -> learn.Scorer:
    """Stored coefficients without a fit: each class's mean weight of each term."""
    sparse = F.unwrap_udt("features")
    cells = vectors.select(F.col("original_label").alias("class"), F.inline(F.arrays_zip(sparse["indices"].alias("ix"), sparse["values"].alias("v"))).alias("ix", "v"))
    sums = cells.groupBy("class", "ix").agg(F.sum("v").alias("v"))
    rows = vectors.groupBy(F.col("original_label").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    table = sums.join(F.broadcast(rows), "class").select("class", "ix", (F.col("v") * STRETCH / F.col("n")).alias("weight"))  # one row a class
    return learn.scorer_from(table, sorted(r["class"] for r in rows.collect()), size)


@query("predict_stored", "reviews")
def _(df):
    """The scorer of ``predict`` with coefficients that SQL can repeat."""
    vectors, vocabulary = _vectors(df)
    scorer = _centroids(vectors, vocabulary.count())
    return _shown(learn.predict(scorer, vectors), scorer.classes, "original_label")


@query("save_scorer", "reviews")
def _(df):
    vectors, vocabulary = _vectors(df)
    path = new_stage_path(df.sparkSession, "scorer")
    sinks.save_scorer(_centroids(vectors, vocabulary.count()), vocabulary, path)
    scorer, _loaded = sinks.load_scorer(df.sparkSession, path)
    return _shown(learn.predict(scorer, vectors), scorer.classes)


@query("evaluate_stored", "reviews")
def _(df):
    """Coefficients from the rows outside the test part, metrics on the test part."""
    vectors, vocabulary = _vectors(df)
    test = F.col("part") == "test"
    return learn.evaluate_fitted(_centroids(vectors.where(~test), vocabulary.count()), vectors.where(test), "original_label")


@query("al_cycle_random_picks", "reviews")
def _(df):
    """The rows that a cycle with random queries picks, by iteration."""
    vectors, _vocabulary = _vectors(df)
    labeled, pool, test = (
        vectors.where(F.col("part") == p).drop("part") for p in ("labeled", "pool", "test")
    )
    return active.run_cycle(labeled, pool, test, "random", 3, label="original_label")[1]


@query("al_cycle", "reviews")
def _(df):
    vectors, _vocabulary = _vectors(df)
    labeled, pool, test = (
        vectors.where(F.col("part") == p).drop("part") for p in ("labeled", "pool", "test")
    )
    records = active.al_cycle(
        labeled, pool, test, "margin", label="original_label"
    )
    return history.history_table(df.sparkSession, {"margin": records})


@query("compare_strategies", "reviews")
def _(df):
    rows = df.where("original_label IS NOT NULL")
    sizes, batch = order.adaptive_sizes(rows.count())
    return active.compare_strategies(
        rows, label="original_label", sizes=sizes, batch_size=batch
    ).history


@query("select_informative", "labeled")
def _(df):
    return active.select_informative(df)


@query("select_informative_only", "labeled")
def _(df):
    """The picked rows without the seed rows."""
    return active.select_informative(df, only_selected=True).select("row_id", "label_auto")


@query("curation_flow")
def _(spark, sf):
    raw = view(spark, sf, "dirty_reviews")
    labeler = annotate.stored_replies(
        view(spark, sf, "responses").unionByName(
            view(spark, sf, "responses").withColumn("row_id", -1 - F.col("row_id"))
        )
    )
    return curation_flow(
        raw, labeler, view(spark, sf, "corrections")
    ).report
