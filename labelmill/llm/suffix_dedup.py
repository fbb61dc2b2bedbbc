"""Exact substring dedup over suffix orders: every byte of a repeated 400-byte string goes.

1. A window (``length`` bytes) is keyed by the least hash of its SEED-byte strings,
   which equal windows share. Consecutive windows of one key form a row, with a
   fingerprint of all its bytes (its context). Rows are narrow; texts are not moved.
2. Contexts are counted by key and fingerprint. A context met twice is a repeat as a
   whole. Only keys with several different contexts, or whose seed recurs inside a
   context, can hide more, and of the former only contexts that agree on half a window's
   bytes beside the seed; one example of each such context is cut out of its text.
3. These contexts are dealt by key into shards of about SHARD_BYTES. Each shard is
   put into suffix order by external induced sorting (``induced``), and neighbours
   that share ``length`` bytes are repeats. Equal windows have one key, hence one
   shard, so no match is lost between shards.
4. Repeated windows are joined to the rows of their contexts and cut out per document.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import buffers, key_map, map_arrow, pieces, row_key, texts
from labelmill.llm.induced import Files, blocks, repeats, suffix_order
from labelmill.llm.words import U, mix, randoms
from labelmill.storage import stage

LENGTH = 400
#: Bytes of the strings whose hashes key a window.
SEED = 64
#: Windows in a row; longer runs (periodic text) are cut, which makes their contexts alike.
ROW = 1024
#: There is a shard for so many bytes of contexts, but at most SHARDS for each shuffle partition.
SHARD_BYTES, SHARDS = 1_000_000, 64
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial sums: bytes a…b have the hash (sums[b] - sums[a]) * inverse^a."""
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(randoms("byte", 256)[data] * powers(_FACTOR, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, a: np.ndarray | slice, b: np.ndarray | slice) -> np.ndarray:
    return mix((sums[b] - sums[a]) * powers(_INVERSE, len(sums))[a])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def window_rows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Rows of windows: text number, first window, number of windows, key, fingerprint, whether the seed recurs, half prints.

    A window reaches at least half of ``length`` less the seed to one side of its seed. The
    half prints are those of the seed with so many bytes to its left and to its right, or
    0 where the row's windows do not reach so far.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U, U, bool, U, U))
    if len(data) < length:
        return none
    seed = min(SEED, length)
    width = length - seed + 1
    sums = prefix_sums(data)
    grams = span_hashes(sums, slice(0, len(data) - seed + 1), slice(seed, len(data) + 1))
    keys = least(grams, width)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    valid = np.repeat(offsets[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    if not len(valid):
        return none
    own = keys[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1)
    # two texts of exactly one window each may follow each other
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    new[firsts] = True
    start = np.flatnonzero(new)
    run = np.diff(np.append(start, len(valid)))
    if run.max() > ROW:
        parts = -(-run // ROW)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, left = np.repeat(start, parts) + inner * ROW, np.repeat(run, parts) - inner * ROW
        run = np.minimum(left, ROW)
    at, key = valid[start], own[start]
    prints = span_hashes(sums, at, at + run + length - 1)
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    twice, seed_at = np.empty(len(at), bool), np.empty(len(at), np.int64)
    for b in blocks(len(at), 4096):
        front = (view[at[b]] == key[b, None]).argmax(axis=1) + at[b]
        last = at[b] + run[b] - 1
        back = last + width - 1 - (view[last][:, ::-1] == key[b, None]).argmax(axis=1)
        twice[b], seed_at[b] = front != back, front
    half, end = (length - seed + 1) // 2, at + run + length - 1
    left, right = seed_at - half, seed_at + seed + half
    left_print = np.where(left >= at, span_hashes(sums, np.maximum(left, 0), seed_at + seed) | U(1), U(0))
    right_print = np.where(right <= end, span_hashes(sums, seed_at, np.minimum(right, len(data))) | U(1), U(0))
    owner = np.searchsorted(offsets, at, "right") - 1
    return owner, at - offsets[owner], run, key, prints, twice, left_print, right_print


def _rows(length: int):
    names = ["doc_id", "rk", "key", "print", "start", "n", "twice", "lefts", "rights"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text"), 500_000):
                owner, start, n, key, prints, twice, lefts, rights = window_rows(*buffers(batch.column("text").slice(a, b - a)), length)
                ids = [batch.column(c).slice(a, b - a).take(pa.array(owner)) for c in ("doc_id", "rk")]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(key.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(start), pa.array(n), pa.array(twice), pa.array(lefts.view(np.int64)), pa.array(rights.view(np.int64))], names=names)

    return run


def _contexts(length: int):
    """Cuts the contexts in ``cuts`` out of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text"), 500_000):
                out = []
                for text, cuts in zip(batch.column("text")[a:b].to_pylist(), batch.column("cuts")[a:b].to_pylist()):
                    raw = text.encode()
                    out += [(c["key"], c["print"], raw[c["start"] : c["start"] + c["n"] + length - 1]) for c in cuts]
                if out:
                    k, p, body = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(p, pa.int64()), pa.array(body, pa.binary())], names=["key", "print", "body"])

    return run


def _sorted_shard(length: int):
    """Repeated windows of the contexts of one shard: (key, print, first, n) for each run of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # scratch of this attempt alone
            keys, prints, sizes, total = [], [], [], 0
            with open(f"{folder}/text", "wb") as f:
                for batch in batches:
                    keys.append(batch.column("key").to_numpy())
                    prints.append(batch.column("print").to_numpy())
                    bodies = batch.column("body").to_pylist()
                    sizes.append(np.array([len(x) for x in bodies], np.int64))
                    for body in bodies:
                        f.write(body)
                        f.write(b"\0")
                        total += len(body) + 1
            if not total:
                return
            keys, prints, sizes = map(np.concatenate, (keys, prints, sizes))
            files = Files(folder)
            raw = np.memmap(f"{folder}/text", np.uint8, "r")
            # 0 ends the string, 1 ends a context, other bytes are raised by 2: bytes of UTF-8 stay below 254
            text, starts = files.array(total + 1, np.uint8), files.array(total + 1, bool)
            for b in blocks(total):
                text[b] = raw[b] + 2
            ends = np.cumsum(sizes + 1) - 1
            text[ends], text[total] = 1, 0
            begin = ends - sizes
            for i in range(0, len(begin), 4096):
                windows = sizes[i : i + 4096] - length + 1
                at = np.repeat(begin[i : i + 4096], windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                starts[at] = True
            order = suffix_order(text, 256, files)
            hit = files.array(total + 1, bool)
            found = repeats(text, order, starts, length)
            for b in blocks(len(found)):
                hit[order[found[b]]] = True
                hit[order[found[b] - 1]] = True
            at = np.flatnonzero(hit)
            if not len(at):
                return
            owner = np.searchsorted(begin, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            count, owner, at = np.diff(np.append(first, len(at))), owner[first], at[first]
            yield pa.RecordBatch.from_arrays([pa.array(keys[owner]), pa.array(prints[owner]), pa.array(at - begin[owner]), pa.array(count)], names=["key", "print", "first", "count"])

    return run


def sharing_halves(contexts: DataFrame) -> DataFrame:
    """(key, print) of the contexts that agree with another one of their key on a half print.

    Two contexts share a window only if they do, as long as their seed occurs once in each.
    """
    halves = contexts.select("key", "print", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("lefts").alias("half")), F.struct(F.lit(1).alias("side"), F.col("rights").alias("half")))).alias("h"))
    halves = halves.where("h.half <> 0").select("key", "print", "h.side", "h.half")
    # written first: the join is one of plain shuffles then, and Spark splits a half that many contexts share
    met = stage(halves.groupBy("key", "side", "half").count().where("count > 1").drop("count"), "met")
    return halves.join(met, ["key", "side", "half"], "left_semi").select("key", "print").distinct()


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The texts (doc_id, rk, text) and per document its repeated windows: runs array<struct<start, end>> of bytes.

    Every join is by keys of the few rows that repeat something; a filter of the
    keys spares the others the shuffle.
    """
    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    base = base.select("doc_id", row_key(F.col("text"), F.col("doc_id")).alias("rk"), "text")
    rows = stage(map_arrow(base, _rows(length), "doc_id long, rk long, key long, print long, start long, n long, twice boolean, lefts long, rights long"), "rows")
    example = F.min(F.struct("doc_id", "rk", "start", "n", "lefts", "rights")).alias("at")
    contexts = stage(rows.groupBy("key", "print").agg(F.count("*").alias("met"), F.max("twice").alias("twice"), example), "contexts")
    open_keys = contexts.groupBy("key").agg(F.count("*").alias("kinds"), F.max("twice").alias("again")).where("kinds > 1 or again").select("key", "again")
    open_keys = stage(open_keys, "keys")
    maybe = stage(contexts.select("key", "print", "at.*").where(key_map(open_keys, "key")("key")).join(open_keys, "key"), "maybe")
    shared = sharing_halves(maybe.where("not again"))
    chosen = maybe.where("again").drop("again").unionByName(maybe.where("not again").drop("again").join(shared, ["key", "print"], "left_semi"))
    chosen = stage(chosen.drop("lefts", "rights"), "chosen")
    size = chosen.agg(F.sum(F.col("n") + length)).first()[0] or 0
    cuts = chosen.groupBy("doc_id", "rk").agg(F.collect_list(F.struct("key", "print", "start", "n")).alias("cuts"))
    # rows equal in doc_id and text give the same contexts: one example is enough
    own = base.where(key_map(chosen, "rk")("rk")).join(_renamed(cuts), _same_document(), "inner").select("text", "cuts")
    bodies = map_arrow(own, _contexts(length), "key long, print long, body binary")
    most = SHARDS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = bodies.repartition(max(1, min(-(-size // SHARD_BYTES), most)), "key")
    found = map_arrow(shards, _sorted_shard(length), "key long, print long, first long, count long")
    whole = contexts.where("met > 1").select("key", "print", F.lit(0).cast("long").alias("first"), F.col("at.n").alias("count"))
    marks = stage(found.union(whole), "marks")
    held = rows.select("doc_id", "rk", "key", "print", "start").where(key_map(marks, "key", "print")("key", "print"))
    runs = held.join(marks, ["key", "print"]).select("doc_id", "rk", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("first") + F.col("count") + (length - 1)).alias("end"))
    return base, runs.groupBy("doc_id", "rk").agg(F.collect_list(F.struct("start", "end")).alias("runs"))


def _renamed(per_document: DataFrame) -> DataFrame:
    return per_document.withColumnsRenamed({"doc_id": "id", "rk": "k"})


def _same_document() -> Column:
    return (F.col("rk") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id"))


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (maximal removed byte runs), kept (the remaining bytes).

    A null text is empty and loses nothing, as any text shorter than ``length``.
    Rows that repeat an earlier one are copies of each other and both lose their
    bytes. Every row stays; other columns are not read.
    """
    base, runs = repeated_windows(docs, length)
    runs = stage(runs, "runs")
    touched = key_map(runs, "rk")("rk")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    both = base.where(touched).join(_renamed(runs), _same_document(), "left").select("doc_id", "text", F.coalesce("runs", none).alias("runs"))
    both = both.union(base.where(~touched).select("doc_id", "text", none.alias("runs")))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                sizes, spans, kept = [], [], []
                for text, found in zip(batch.column("text")[a:b].to_pylist(), batch.column("runs")[a:b].to_pylist()):
                    raw = text.encode()
                    gone = joined([(r["start"], r["end"]) for r in found])
                    edges = [0, *(x for s in gone for x in s), len(raw)]
                    sizes.append(len(raw))
                    spans.append([{"start": x, "end": y} for x, y in gone])
                    kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], schema=schema)

    return map_arrow(both, run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def removed_bytes(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
