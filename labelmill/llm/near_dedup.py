"""MinHash near-dedup with a circulant signature, exact links and components.

One pass hashes every whole text into its set of word shingles. A shingle's first
permutation is its place among 2^20 (mixed hash); the second one is a fixed random
permutation that is shifted by one place for each signature coordinate, so
coordinate k of a set is the least value of the second permutation at (place + k).
Bands of the signature propose pairs. Every proposed link is confirmed on the full
shingle sets.

Copies with equal sets are one node. A bucket's members are not paired with each
other: each is compared with the bucket's hub, the member that shares most buckets
with others. Where that leaves several components, members x and y are looked up by
their differences from the hub h. With D(x) the symmetric difference of x and h,
a link of x and y needs |D(x) & D(y)| >= (|D(x)| + |D(y)| - r * (|x| + |y|)) / 2 with
r = (1 - s) / (1 + s) for a similarity s; that is above zero unless both are linked
with h. So x and y share a member of D early in any fixed order: among the first
(1 - s) / s * |x| + 1 of D(x). Rare shingles go first, so near copies with edits of
their own, which a pairwise comparison would meet in squares, hardly meet at all.
Nothing is capped and no link is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import buffers, key_map, map_arrow, narrow, pieces, place, texts, wide
from labelmill.llm.components import merge_labels
from labelmill.llm.words import U, mix, randoms, shingle_hashes, word_hashes
from labelmill.storage import stage

PLACES = 1 << 20
#: 32 bands of 4: at a similarity of 0.85 a pair is missed with probability 6e-11, at 0.8 with 5e-8.
BANDS, ROWS = 32, 4
_circle: dict[int, np.ndarray] = {}


def circle() -> np.ndarray:
    """Row p holds the shifted second permutation's values for a shingle placed at p."""
    if 0 not in _circle:
        order = np.argsort(randoms("circle", PLACES)[:PLACES], kind="stable").astype(np.int32)
        ring = np.concatenate((order, order[: BANDS * ROWS]))
        _circle[0] = np.lib.stride_tricks.sliding_window_view(ring, BANDS * ROWS)
    return _circle[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of one set."""
    at, rows = (shingles >> U(44)).astype(np.int64), circle()
    best = rows[at[:4096]].min(axis=0)
    for i in range(4096, len(at), 4096):
        np.minimum(best, rows[at[i : i + 4096]].min(axis=0), out=best)
    return best


def band_hashes(sig: np.ndarray) -> np.ndarray:
    parts = sig.astype(np.uint64).reshape(BANDS, ROWS)
    factors = randoms("bands", BANDS * ROWS)[: BANDS * ROWS].reshape(BANDS, ROWS)
    return mix((parts * factors).sum(axis=1, dtype=np.uint64) + randoms("band", BANDS)[:BANDS]).view(np.int64)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingles of each text."""
    column = batch.column("text")
    for a, b in pieces(column):
        words, bounds = word_hashes(*buffers(column.slice(a, b - a)))
        hashes, ends = shingle_hashes(words, bounds, k)
        for i in range(b - a):
            yield a + i, np.unique(hashes[ends[i] : ends[i + 1]])


def _sketches(k: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ds, bands = [], [], []
            for _, s in _sets(batch, k):
                n.append(len(s))
                ds.append((int(s.sum(dtype=U).view(np.int64)), int(mix(s ^ U(0xA5A5A5A5)).sum(dtype=U).view(np.int64))))
                bands.append(band_hashes(signature(s)) if len(s) else None)
            if n:
                d1, d2 = zip(*ds)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], schema=kinds)

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text"), 200_000):
                part = batch.slice(a, b - a)
                sets = [s.view(np.int64) for _, s in _sets(part, k)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "items"])

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Texts are linked if 100 * intersection >= percent * union of their sets of
    ``words``-word shingles. Nulls and texts without words have an empty set and are
    linked with nothing. Rows are compared by their text; rows with one doc_id are
    one node. A row without doc_id is never linked: component_id is null, kept true.
    An empty table gives an empty result; other columns are not read.
    """
    own = texts(docs, key, text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(map_arrow(own, _sketches(words), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"), "sketches")
    some = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = stage(some.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")), "nodes")
    named = rows.select("doc_id", "n_shingles", "d1", "d2").join(nodes.select("d1", "d2", "node"), ["d1", "d2"], "left")
    labels = _components(own, nodes, words, percent)
    out = named.join(labels, "node", "left")
    # an empty set has no node of its own
    comp = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "node")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), comp).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _components(own: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, comp) of the nodes that share a bucket with another."""
    exploded = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("bucket")
    members = stage(exploded.join(shared, "bucket").distinct(), "members")
    labels = stage(members.select("node", F.col("node").alias("comp")).distinct(), "labels")
    if labels.isEmpty():
        return labels
    ids = nodes.join(labels.select("node"), "node", "left_semi").select("node").distinct()
    chosen = own.join(ids, own.doc_id == ids.node).select("node", "text")
    sets = stage(map_arrow(chosen, _full_sets(words), "node long, items array<long>"), "sets")
    # a member's standing is the number of members that it shares buckets with
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    standing = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("s"))
    top = members.join(standing, "node").groupBy("bucket").agg(F.max(F.struct("s", (-F.col("node")).alias("low"))).alias("top"))
    hubs = top.select("bucket", (-F.col("top.low")).alias("hub"))
    groups = stage(members.join(hubs, "bucket").where("node <> hub").select("hub", "node", "n").distinct(), "groups")
    pairs = groups.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    labels = merge_labels(labels, stage(_linked(pairs, sets, percent), "links"))
    by = lambda name, comp: labels.select(F.col("node").alias(name), F.col("comp").alias(comp))
    found = groups.join(by("node", "comp"), "node").join(by("hub", "top"), "hub")
    apart = found.groupBy("hub").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("hub")
    live = stage(found.join(apart, "hub").select("hub", "node", "comp"), "live")
    if live.isEmpty():
        return labels
    candidates = stage(_alike(live, sets, percent), "pairs")
    return merge_labels(labels, stage(_linked(candidates, sets, percent), "links"))


def _alike(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a group that are in different components and may be linked, by their differences from the hub."""
    used = live.select("node").union(live.select("hub")).distinct()
    items = sets.join(used, "node", "left_semi").select("node", F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1")
    ranked = items.join(common, "item", "left").groupBy("node").agg(F.collect_list(F.struct("item", F.coalesce("df", F.lit(1)).alias("df"))).alias("items"))
    ranked = stage(ranked.select("node", "items.item", "items.df"), "ranked")
    hub = ranked.select(F.col("node").alias("hub"), F.col("item").alias("hub_item"), F.col("df").alias("hub_df"))
    both = live.join(ranked, "node").join(hub, "hub")
    schema = pa.schema([(n, pa.int64()) for n in ("hub", "node", "comp", "n", "d", "item", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name, i: np.asarray(batch.column(name)[i].values)
            out = [[] for _ in schema]
            for i in range(len(batch)):
                x, h = get("item", i), get("hub_item", i)
                new, gone = ~np.isin(x, h), ~np.isin(h, x)
                order = np.concatenate((get("df", i)[new], -get("hub_df", i)[gone]))
                side = np.repeat([0, 1], [new.sum(), gone.sum()])
                item = np.concatenate((x[new], h[gone]))
                first = np.lexsort((item, order, side))[: (100 - percent) * len(x) // percent + 1]
                shown = np.flatnonzero(order[first] != 1)  # a shingle of one text alone meets nothing
                same = [batch.column(c)[i].as_py() for c in ("hub", "node", "comp")] + [len(x), len(item)]
                for column, value in zip(out, same):
                    column.append(np.full(len(shown), value))
                out[5].append(item[first[shown]])
                out[6].append(shown)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], schema=schema)

    rows = stage(map_arrow(both, run, "hub long, node long, comp long, n long, d long, item long, place long"), "differences")
    other = rows.select("hub", "item", F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("d").alias("db"), F.col("place").alias("pb"))
    plus, minus = 100 + percent, 100 - percent
    enough = 2 * plus * F.least(F.col("d") - F.col("place"), F.col("db") - F.col("pb")) >= plus * (F.col("d") + F.col("db")) - minus * (F.col("n") + F.col("nb"))
    sized = 100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")
    # the conditions stand in the join: what fails them is never a row
    alike = rows.join(other, [rows.hub == other.hub, rows.item == other.item, F.col("node") < F.col("b"), F.col("comp") != F.col("cb"), enough, sized])
    return alike.select(F.col("node").alias("a"), "b").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b").distinct()


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each group of near duplicates, the one of the smallest doc_id.

    Documents are told apart by doc_id and text together: rows that share a doc_id but
    not their text are judged each by its own text, and rows equal in both are copies,
    of which one stays. Rows without doc_id or without words stay, repeated ones too.
    """
    own, names = wide(docs)
    doc_id, text = F.col(place(names, "doc_id")), F.coalesce(F.col(place(names, "text")).cast("string"), F.lit(""))
    own = own.withColumn("lm_node", F.when(doc_id.isNotNull(), F.xxhash64(doc_id, text)))
    nodes = own.select("lm_node", doc_id.alias("id"), text.alias("text"))
    found = stage(near_duplicates(nodes, words, percent, key="lm_node").where("doc_id is not null and n_shingles > 0"), "near")
    # of a group the smallest doc_id stays; its members are told apart by their nodes
    ids = nodes.where("lm_node is not null").select(F.col("lm_node").alias("doc_id"), "id").distinct()
    groups = found.select("doc_id", "component_id").distinct().join(ids, "doc_id")
    first = groups.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("doc_id"))
    dropped = stage(groups.join(kept, "doc_id", "left_anti").select(F.col("doc_id").alias("lm_gone")), "dropped")
    repeated = stage(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("lm_again")), "repeated")
    # most rows surely stay and are not moved
    doubtful = F.coalesce(key_map(dropped, "lm_gone")("lm_node") | key_map(repeated, "lm_again")("lm_node"), F.lit(False))
    rest = own.where(doubtful).join(dropped, F.col("lm_node") == F.col("lm_gone"), "left_anti")
    rest = rest.join(repeated, F.col("lm_node") == F.col("lm_again"), "left")
    once = rest.where("lm_again is not null").dropDuplicates(["lm_node"])
    return narrow(own.where(~doubtful).union(rest.where("lm_again is null").union(once).drop("lm_again")), names)
