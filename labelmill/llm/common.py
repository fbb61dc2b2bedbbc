"""Helpers shared by the operators: columns by exact name, Arrow batches, row keys."""

from __future__ import annotations

import importlib.util
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows are handled in pieces of about so many text bytes, which bounds a task's arrays.
PIECE_BYTES = 2_000_000


_sent_to: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Spark this package's source for the workers, once per application.

    Workers then import it wherever they run. The archive is only the upload's
    source; Spark's own file service brings it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _sent_to:
        return
    root = Path(importlib.util.find_spec("labelmill").submodule_search_locations[0])
    archive = Path(tempfile.mkdtemp()).resolve() / "labelmill.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _sent_to.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, matched by exact name, whatever other columns are called.

    A further column whose name differs in case alone does not make the name ambiguous;
    without an exact match, the first that differs in case only is taken.
    """
    lower = [c.lower() for c in df.columns]
    places = [df.columns.index(n) if n in df.columns else lower.index(n.lower()) for n in names]
    own = df.toDF(*[f"lm_{i}" for i in range(len(df.columns))])
    return own.select(*[F.col(f"lm_{i}").alias(n) for i, n in zip(places, names)])


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text is an empty one."""
    own = pick(docs, key, text)
    return own.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def row_key(text: Column, key: Column) -> Column:
    """With doc_id, tells rows apart; rows equal in both are one document."""
    return F.xxhash64(key, text)


def wide(df: DataFrame, **more: Column) -> tuple[DataFrame, list[str]]:
    """All columns under neutral names lm_0…, with further ones; and the old names."""
    own = df.toDF(*[f"lm_{i}" for i in range(len(df.columns))])
    return own.withColumns(more) if more else own, df.columns


def place(names: list[str], name: str) -> str:
    return f"lm_{names.index(name) if name in names else [n.lower() for n in names].index(name.lower())}"


def narrow(df: DataFrame, names: list[str]) -> DataFrame:
    """Undo ``wide``: the first columns under their old names, nothing else."""
    return df.select(*[F.col(f"lm_{i}") for i in range(len(names))]).toDF(*names)


def map_rows(
    df: DataFrame, rows: Callable[[list, list], Iterable[tuple]], schema: str, names: list[str], types: list
) -> DataFrame:
    """mapInArrow over (doc_id, text): ``rows(ids, texts)`` yields tuples of the result.

    Batches are cut into pieces of about PIECE_BYTES of text, so that a batch of
    very long texts does not multiply in memory.
    """
    arrow = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                part = batch.slice(a, b - a)
                out = list(rows(part.column("doc_id").to_pylist(), part.column("text").to_pylist()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)], schema=arrow
                    )

    return map_arrow(df, run, schema)


#: Bits of a key map: a table of 2^MAP_BITS / 8 bytes, whatever the input.
MAP_BITS = 24


def key_map(keys: DataFrame, *names: str) -> Callable[..., Column]:
    """A condition on columns that holds for all values of ``names`` in ``keys`` and for few others.

    It lets a join shuffle only rows that have a partner, and a few more. A bitmap of
    fixed size, built by an aggregate and read as a scalar: no Python, nothing on the
    driver but the table. With far more keys than bits the condition holds for every
    row, and the join after it is as right as before.
    """

    def bit(columns: tuple[str, ...]) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*columns), 64 - MAP_BITS)

    words = keys.select(bit(names).alias("p")).groupBy(F.shiftright("p", 6).alias("id"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS INT))")).alias("bits"))
    every = keys.sparkSession.range(1 << (MAP_BITS - 6)).join(words, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    table = every.agg(F.transform(pairs, lambda x: x["bits"]).alias("table")).scalar()

    def holds(*columns: str) -> Column:
        p = bit(columns)
        word = F.get(table, F.shiftright(p, 6).cast("int"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
        return word.bitwiseAND(one) != 0

    return holds


def filter_rows(docs: DataFrame, keep: Callable[[pa.Array], np.ndarray], text: str = "text") -> DataFrame:
    """The rows whose text passes ``keep`` (string array without nulls -> booleans), with all columns; no shuffle."""
    own, names = wide(docs)
    own = own.withColumn("lm_text", F.coalesce(F.col(place(names, text)).cast("string"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = batch.column("lm_text")
            rest = batch.drop_columns(["lm_text"])
            for a, b in pieces(body):
                yield rest.slice(a, b - a).filter(pa.array(keep(body.slice(a, b - a)), pa.bool_()))

    kept = map_arrow(own, run, own.drop("lm_text").schema)
    return narrow(kept, names)


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> list[tuple[int, int]]:
    """Row ranges of about ``size`` text bytes each; a longer text stands alone."""
    _, offsets = buffers(column)
    cuts, start = [], 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), len(column))
        cuts.append((start, end))
        start = end
    return cuts


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and each row's bounds in them."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
