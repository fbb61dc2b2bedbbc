"""TF-IDF: sublinear term frequency, smooth idf, L2-normalised rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions.columns import BROADCAST_ROWS, ROW_ID, TEXT, as_text, lookup, small_side
from labelmill.functions.ranks import commonest
from labelmill.storage import new_stage_path, stage

MAX_FEATURES = 5000
# Fixed value: a term is a run of at least two word characters.
NOT_WORD = r"[^\p{L}\p{N}_]+"
MIN_TERM_CHARS = 2
# Terms a vocabulary held in memory may have.
MAX_VOCABULARY = BROADCAST_ROWS


def terms(text: Column) -> Column:
    """Lower-cased terms of a text in order, repeats included."""
    return F.filter(_runs(text), lambda t: F.length(t) >= MIN_TERM_CHARS)


def _runs(text: Column) -> Column:
    return F.split(F.lower(as_text(text)), NOT_WORD)


def tokenize(df: DataFrame, text: str = TEXT, name: str = "terms") -> DataFrame:
    return df.withColumn(name, terms(F.col(text)))


def tfidf_fit(
    df: DataFrame, text: str = TEXT, max_features: int = MAX_FEATURES, n: int | None = None
) -> DataFrame:
    """Vocabulary (ix, term, doc_freq, total, idf) of the commonest terms.

    Each text is split once: all its terms give the total, its distinct ones
    doc_freq. Counts combine on the map side, so
    neither a text nor a frequent term is ever gathered in one place; the cut is
    found by rank selection, so the driver reads the chosen terms only. Ties at the cut go
    to the smaller term; ``ix`` follows the order of the terms. The result has at
    most ``max_features`` rows and is held as a local table. ``n`` is the number
    of rows, if it is known.
    """
    if max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features above {MAX_VOCABULARY} cannot be broadcast")
    split = df.select(_runs(F.col(text)).alias("all"))
    mark = lambda first: lambda t: F.struct(t.alias("term"), F.lit(first).alias("first"))
    marked = F.concat(F.transform("all", mark(0)), F.transform(F.array_distinct("all"), mark(1)))
    counts = (
        split.select(F.inline(marked))
        .where(F.length("term") >= MIN_TERM_CHARS)
        .groupBy("term")
        .agg(F.sum("first").alias("doc_freq"), F.sum(1 - F.col("first")).alias("total"))
    )
    rows = commonest(counts, "total", "term", max_features).collect()
    n = df.count() if n is None else n
    found = [(r["term"], r["doc_freq"], r["total"]) for r in sorted(rows, key=lambda r: r["term"])]
    return _vocabulary(df.sparkSession, found, n)


def _vocabulary(spark: SparkSession, found: Sequence[tuple[str, int, int]], n: int) -> DataFrame:
    """(ix, term, doc_freq, total, idf) from (term, doc_freq, total) in order, over ``n`` rows."""
    vocabulary = spark.createDataFrame(
        [(i, *entry) for i, entry in enumerate(found)],
        "ix int, term string, doc_freq bigint, total bigint",
    )
    idf = F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)
    return vocabulary.coalesce(1).withColumn("idf", idf)


def tfidf_transform(
    df: DataFrame,
    vocabulary: DataFrame,
    text: str = TEXT,
    id_col: str = ROW_ID,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sparse rows (id, keep…, indices, values); a row without known terms is empty.

    Narrow from scan to result: terms are looked up in the broadcast vocabulary
    and weighted inside their row, so nothing is shuffled and no row reaches Python.
    """
    known = vocabulary.select("ix", "term", "idf").orderBy("ix").limit(MAX_VOCABULARY + 1).collect()
    if len(known) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY} terms")
    counted = term_counts(df, [r["term"] for r in known], text, id_col, keep)
    return weighted(counted, [r["idf"] for r in known], id_col, keep)


def term_counts(
    df: DataFrame, known: Sequence[str], text: str = TEXT, id_col: str = ROW_ID, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows (id, keep…, indices, counts) of the listed terms that occur in each text."""
    counter = CountVectorizerModel.from_vocabulary(list(known), "_terms", "_counts")
    counted = counter.transform(df.select(id_col, *keep, terms(F.col(text)).alias("_terms")))
    sparse = counted.select(id_col, *keep, F.unwrap_udt("_counts").alias("c"))
    return sparse.select(id_col, *keep, F.col("c.indices").alias("indices"), F.col("c.values").alias("counts"))


def weighted(counted: DataFrame, idf: Sequence[float], id_col: str = ROW_ID, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (id, keep…, indices, values) of ``term_counts`` rows: sublinear, times idf, normalised."""
    raw = F.zip_with(
        "indices", "counts",
        lambda ix, tf: (F.lit(1.0) + F.log(tf)) * F.get(lookup(idf), ix),
    )
    rows = counted.select(id_col, *keep, "indices", raw.alias("raw"))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda acc, w: acc + w * w))
    # The norm is an argument, not part of the lambda, so it is computed once per row.
    norms = F.array_repeat(norm, F.size("raw"))
    return rows.select(
        id_col, *keep, "indices", F.zip_with("raw", norms, lambda w, n: w / n).alias("values")
    )


def tfidf_vectors(
    df: DataFrame,
    text: str = TEXT,
    max_features: int = MAX_FEATURES,
    id_col: str = ROW_ID,
    keep: Sequence[str] = (),
    part: str | None = None,
    fitted: Column | None = None,
    n: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary of ``tfidf_fit`` and staged vectors of ``tfidf_transform`` over the same rows.

    Texts are split twice, not three times over: once for the totals of all terms, and
    once for the counts of the chosen ones, which are written; doc_freq and the weights
    are taken from these narrow rows. ``fitted`` says which rows the vocabulary is fitted
    on (all, if None), ``n`` their number; it uses kept columns only.
    """
    if max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features above {MAX_VOCABULARY} cannot be broadcast")
    mine = df if fitted is None else df.where(fitted)
    # the split is an argument of explode, not a column: Spark would filter by it and split once more
    every = mine.select(F.explode(_runs(F.col(text))).alias("term")).where(F.length("term") >= MIN_TERM_CHARS)
    totals = every.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    rows = sorted(commonest(totals, "total", "term", max_features).collect(), key=lambda r: r["term"])
    counted = stage(term_counts(df, [r["term"] for r in rows], text, id_col, keep), "counted")
    seen = counted if fitted is None else counted.where(fitted)
    met = seen.select(F.explode("indices").alias("ix")).groupBy("ix").agg(F.count(F.lit(1)).alias("n")).collect()
    doc_freq = {r["ix"]: r["n"] for r in met}
    n = mine.count() if n is None else n
    vocabulary = _vocabulary(df.sparkSession, [(r["term"], doc_freq[i], r["total"]) for i, r in enumerate(rows)], n)
    idf = [r["idf"] for r in vocabulary.select("ix", "idf").orderBy("ix").collect()]
    features = weighted(counted, idf, id_col, keep)
    return vocabulary, stage_vectors(features, len(rows), part)


def feature_table(features: DataFrame, vocabulary: DataFrame, id_col: str = ROW_ID) -> DataFrame:
    """Sparse rows as a long table (id, term, weight)."""
    pairs = F.arrays_zip(F.col("indices").alias("ix"), F.col("values").alias("weight"))
    cells = features.select(id_col, F.inline(pairs).alias("ix", "weight"))
    names = vocabulary.select("ix", "term")
    return cells.join(small_side(names), "ix").select(id_col, "term", "weight")


def stage_vectors(features: DataFrame, size: int, part: str | None = None) -> DataFrame:
    """Write sparse rows once and read them back as MLlib vectors.

    A vector is stored as the struct (type 0, size, indices, values), so reading
    the table with the vector type needs no Python on any row. ``part`` names a
    column of few values to lay the table out by: a filter on it then reads the
    files of that part alone.
    """
    spark = features.sparkSession
    others = [f for f in features.schema.fields if f.name not in ("indices", "values")]
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values"
    )
    path = new_stage_path(spark, "vectors")
    rows = features.select(*[f.name for f in others], vector.alias("features"))
    rows.write.parquet(path, partitionBy=part)
    schema = T.StructType([*others, T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path).select(*schema.names)
