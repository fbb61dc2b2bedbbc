"""Order-based operators over an explicit row id: head, shuffle, sample, split, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.functions.columns import KEY_DIGITS, ROW_ID, seeded_key
from labelmill.functions.ranks import first_k, rank_conditions

SEED = 42
# The leading 16 of the key's 60 bits: 65,536 buckets at any table size.
BUCKET_SHIFT = KEY_DIGITS * 4 - 16
# Spark cuts groups on the map side up to this rank (its default threshold).
LOCAL_LIMIT = 1000
SALTS = 256


def head_rows(df: DataFrame, n: int, id_col: str = ROW_ID) -> DataFrame:
    """The first ``n`` rows by id."""
    return first_k(df, F.col(id_col), n, id_col)


def global_rank(df: DataFrame, key: str, id_col: str = ROW_ID, name: str = "position") -> DataFrame:
    """0-based rank of every row by (key, id), for an evenly spread 60-bit key.

    Rows are numbered inside key buckets and shifted by the sizes of the earlier
    buckets. Only the bucket sizes, 65,536 rows at most, pass through one task.
    """
    bucket = F.shiftright(F.col(key), BUCKET_SHIFT)
    sizes = df.select(bucket.alias("_bucket")).groupBy("_bucket").count()
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_bucket").orderBy(key, id_col)
    return (
        df.withColumn("_bucket", bucket)
        .withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_at"))
        .drop("_bucket", "_at", "_offset")
    )


def seeded_shuffle(df: DataFrame, id_col: str = ROW_ID, seed: int = SEED) -> DataFrame:
    """Repeatable permutation: adds each row's 0-based ``position``."""
    keyed = df.withColumn("_key", seeded_key(id_col, seed))
    return global_rank(keyed, "_key", id_col).drop("_key")


def sample_k(df: DataFrame, k: int, id_col: str = ROW_ID, seed: int = SEED) -> DataFrame:
    """``k`` rows without replacement, or all of them if there are fewer."""
    return first_k(df, seeded_key(id_col, seed), k, id_col)


def split_by_rank(
    df: DataFrame,
    parts: Mapping[str, int | None],
    id_col: str = ROW_ID,
    seed: int = SEED,
    name: str = "part",
    ids: DataFrame | None = None,
    total: int | None = None,
) -> DataFrame:
    """Cut the shuffled rows into parts of exact sizes, in order; the last takes the rest.

    Cuts are found by rank selection on the shuffle key, so a part is a filter
    on the scan and no row moves. ``ids`` may give the ids of the same rows as a
    written table, if the rows themselves are costly to scan, ``total`` their number.
    """
    keyed = df.withColumn("_key", seeded_key(id_col, seed))
    keys = keyed if ids is None else ids.withColumn("_key", seeded_key(id_col, seed))
    names = list(parts)
    ends = list(accumulate(parts[part] for part in names[:-1]))
    label: Column | None = None
    conditions = rank_conditions(keys, "_key", id_col, ends, total=total)
    for part, inside in zip(names, conditions):
        label = F.when(inside, part) if label is None else label.when(inside, part)
    label = F.lit(names[-1]) if label is None else label.otherwise(names[-1])
    return keyed.withColumn(name, label).drop("_key")


def seed_pool_sizes(n: int) -> dict[str, int | None]:
    """60 % seed, at least 10 rows; the rest is the pool."""
    return {"seed": min(n, max(10, int(0.6 * n))), "pool": None}


def learning_sizes(n: int, n_start: int = 50) -> dict[str, int | None]:
    """20 % test, at least 50 rows; up to half of the rest starts labelled."""
    rest = max(n - max(50, int(0.2 * n)), 0)
    start = min(n_start, int(0.5 * rest))
    return {"labeled": start, "pool": rest - start, "test": None}


def adaptive_sizes(n: int, n_iterations: int = 5) -> tuple[dict[str, int | None], int]:
    """Shares of the table as part sizes and batch size; a short pool shrinks the batch."""
    rest = max(n - max(15, int(0.2 * n)), 0)
    start = min(rest, max(10, int(0.15 * n)))
    batch, pool = max(3, int(0.05 * n)), rest - start
    if pool < batch:
        batch = max(1, pool // n_iterations)
    return {"labeled": start, "pool": pool, "test": None}, batch


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int = 5) -> DataFrame:
    """The first ``k`` rows of each group.

    For a small ``k`` every map task keeps ``k`` rows per group before the
    shuffle. For a larger one a hot group is first cut down in salted parts.
    """
    def first(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")

    if k <= LOCAL_LIMIT:
        return first(df, keys)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    return first(first(salted, [*keys, "_salt"]).drop("_salt"), keys)


def concat_tables(*dfs: DataFrame) -> DataFrame:
    """Rows of all tables over the union of their columns."""
    result = dfs[0]
    for df in dfs[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
