"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Normalised words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. The
windows of the benchmark (n consecutive words; a shorter item is one window) are
collected in blocks of at most BLOCK_CHARS characters of items, whose size is known
before they are sent; each block is broadcast and every document is scanned whole.
A window found by its hash is verified word by word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import buffers, filter_rows, joined, map_arrow, narrow, pieces, place, row_key, texts, wide
from labelmill.llm.words import NOT_ALNUM, U, mix, randoms, word_hashes
from labelmill.storage import stage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Characters of benchmark text in one broadcast; a larger benchmark takes several scans.
BLOCK_CHARS = 8_000_000


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else; no character moves."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def normal_words(text: str) -> list[str]:
    return WORD.findall(lowered(text))


class Windows:
    """The windows of some items: their hashes by length, and words -> items."""

    def __init__(self, items: list[tuple[str | None, str]], n: int) -> None:
        found: dict[tuple[str, ...], set] = defaultdict(set)
        for item, text in items:
            words = normal_words(text)
            size = min(n, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found[tuple(words[i : i + size])].add(item)
        self.items = dict(found)
        self.hashes = {}
        for size in {len(w) for w in found}:
            column = pa.array([" ".join(w) for w in found if len(w) == size])
            hashes, bounds = word_hashes(*buffers(column), NOT_ALNUM)
            self.hashes[size] = np.unique(rolling(hashes, size)[bounds[:-1]])

    def places(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Per text (by number) the word ranges whose hash is a window's."""
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, known in self.hashes.items():
            if len(hashes) < size:
                continue
            got = rolling(hashes, size)
            at = np.searchsorted(known, got)
            hits = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == got)
            owner = np.searchsorted(bounds, hits, "right") - 1
            for t, i in zip(owner.tolist(), hits.tolist()):
                if i + size <= bounds[t + 1]:
                    out[t].append((i - int(bounds[t]), i - int(bounds[t]) + size))
        return out

    def verified(self, words: list[str], ranges: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[str]]:
        """The ranges whose words are a window's, merged, and the items of those windows."""
        sure, items = [], set()
        for a, b in ranges:
            owners = self.items.get(tuple(words[a:b]))
            if owners:
                sure.append((a, b))
                items |= owners
        return joined(sure), sorted(x for x in items if x is not None)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words."""
    factors, n = randoms("window", size), len(hashes) - size + 1
    total = np.zeros(n, U)
    for j in range(size):
        total += hashes[j : n + j] * factors[j]
    return mix(total)


def benchmark_blocks(benchmark: DataFrame, n: int) -> Iterable[Broadcast]:
    """Broadcasts of windows, each of items with at most BLOCK_CHARS characters (or one longer item)."""
    spark = benchmark.sparkSession
    items = texts(benchmark, "item_id").select(F.col("doc_id").cast("string").alias("item"), "text").where("text <> ''").distinct()
    block, size, sent = [], 0, 0
    for row in items.orderBy("item", "text").toLocalIterator():
        if block and size + len(row.text) > BLOCK_CHARS:
            yield spark.sparkContext.broadcast(Windows(block, n))
            block, size, sent = [], 0, sent + 1
        block.append((row.item, row.text))
        size += len(row.text)
    if block or not sent:
        yield spark.sparkContext.broadcast(Windows(block, n))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per row: doc_id, rk, n_words, ranges (words hit, merged), chars (the same as code points), items (sorted item ids).

    A null text has no words, nor does a null benchmark text make a window; an item
    without item_id counts as window but not as item. An empty benchmark hits
    nothing. Rows are independent of each other and all stay, repeated ones too, however
    many blocks the benchmark has; other columns are not read.
    """
    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = base.select("doc_id", row_key(F.col("text"), F.col("doc_id")).alias("rk"), "text")
    span = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])
    schema = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("n_words", pa.int64()), ("ranges", pa.list_(span)), ("items", pa.list_(pa.string()))])
    kinds = "doc_id long, rk long, n_words long, ranges array<struct<first:long,last:long,start:long,end:long>>, items array<string>"

    def scan(block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = block.value
            for batch in batches:
                for a, b in pieces(batch.column("text")):
                    column = batch.column("text").slice(a, b - a)
                    hashes, bounds = word_hashes(*buffers(column), NOT_ALNUM)
                    ranges, items = [[] for _ in range(b - a)], [[] for _ in range(b - a)]
                    for t, places in windows.places(hashes, bounds).items():
                        text = lowered(column[t].as_py())
                        spans = [m.span() for m in WORD.finditer(text)]
                        sure, items[t] = windows.verified([text[x:y] for x, y in spans], places)
                        ranges[t] = [{"first": x, "last": y - 1, "start": spans[x][0], "end": spans[y - 1][1]} for x, y in sure]
                    ids = [batch.column(c).slice(a, b - a) for c in ("doc_id", "rk")]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(np.diff(bounds)), pa.array(ranges, schema.field(3).type), pa.array(items, schema.field(4).type)], schema=schema)

        return map_arrow(keyed, run, kinds)

    scans = [scan(b) for b in benchmark_blocks(benchmark, n)]
    if len(scans) == 1:
        return scans[0]
    out = scans[0]
    for more in scans[1:]:
        out = out.union(more)
    out = stage(out, "hits").groupBy("doc_id", "rk").agg(
        F.first("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_set("ranges"))).alias("ranges"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        (F.count("*") / len(scans)).cast("int").alias("times"),
    )
    # rows that repeat id and text are one group here, whose result stands for each of them
    out = out.withColumn("ranges", F.array_sort("ranges")).withColumn("ranges", _joined(F.col("ranges"))).withColumn("items", F.array_sort("items"))
    out = out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.drop("times", "time")


def _joined(ranges):
    """Overlapping or touching ranges of several blocks become one; the input is sorted."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>")

    def add(done, r):
        top = F.element_at(done, -1)
        joint = F.struct(top["first"].alias("first"), F.greatest(top["last"], r["last"]).alias("last"), top["start"].alias("start"), F.greatest(top["end"], r["end"]).alias("end"))
        apart = (F.size(done) == 0) | (r["first"] > F.coalesce(F.try_element_at(done, F.lit(-1))["last"], F.lit(-2)) + 1)
        return F.when(apart, F.concat(done, F.array(r))).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joint)))

    return F.aggregate(ranges, empty, add)


def _clean(block: Broadcast, column: pa.Array) -> np.ndarray:
    """Which texts hold no window of the block."""
    hashes, bounds = word_hashes(*buffers(column), NOT_ALNUM)
    clean = np.ones(len(column), bool)
    for t, places in block.value.places(hashes, bounds).items():
        clean[t] = not block.value.verified(normal_words(column[t].as_py()), places)[0]
    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, spans: bool = False) -> DataFrame:
    """The documents without those that hold a benchmark window; with ``spans`` only the hit passages go.

    Nothing else changes: rows without a hit stay as they are, n_chars (if there)
    follows a text that was cut. Null and empty texts have no hit, repeated rows are
    judged alike, an empty table or benchmark changes nothing.
    """
    if not spans:
        for block in benchmark_blocks(benchmark, n):
            docs = filter_rows(docs, partial(_clean, block))
        return docs
    found = contamination(docs, benchmark, n).where(F.size("ranges") > 0).select(F.col("doc_id").alias("lm_id"), F.col("rk").alias("lm_rk"), F.col("ranges").alias("lm_hits")).distinct()
    own, names = wide(docs)
    doc_id, text = F.col(place(names, "doc_id")), F.col(place(names, "text"))
    own = own.withColumn("lm_key", row_key(F.coalesce(text.cast("string"), F.lit("")), doc_id.cast("long")))
    same = (F.col("lm_key") == F.col("lm_rk")) & doc_id.cast("long").eqNullSafe(F.col("lm_id"))
    out = own.join(found, same, "left")
    hits = F.col("lm_hits")
    edges = F.concat(F.transform(hits, lambda r: r["start"]), F.array(F.length(text).cast("long")))
    before = lambda i: F.coalesce(F.get(hits, i - 1)["end"], F.lit(0))
    cut = F.array_join(F.transform(edges, lambda e, i: F.substr(text, before(i) + 1, e - before(i))), "")
    out, cut = out.withColumn("lm_cut", cut), F.col("lm_cut")
    new = {place(names, "text"): F.when(hits.isNull(), text).otherwise(cut)}
    if "n_chars" in names:
        new[place(names, "n_chars")] = F.when(hits.isNull(), F.col(place(names, "n_chars"))).otherwise(F.length(cut).cast(docs.schema["n_chars"].dataType))
    return narrow(out.withColumns(new), names)
