"""Ranked lexical search: every document against each item, best scores exact.

Documents are read once into segments: for the terms of the items, the postings
(document, occurrences) of some megabytes of text. A segment's postings stay together,
so no list of a frequent word ever meets in one place and nothing but counts and
winners is shuffled. Document counts of the terms are added up over all segments first.

A segment is searched by a hybrid of two ways. The short lists of an item are summed
term at a time into accumulators. These then are one iterator with a known greatest
sum among the long lists, and the iterators are met document at a time: only those
whose bounds together reach the score to beat bring candidates, the others are
looked up for candidates that can still reach it, skipping everything between. The
score to beat grows from window to window and from segment to segment of a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import buffers, map_arrow, pieces, texts
from labelmill.llm.decontaminate import normal_words
from labelmill.llm.words import NOT_ALNUM, word_hashes
from labelmill.storage import stage

BEST = 20
#: Characters of items in one broadcast; more items take further reads of the documents.
BLOCK_CHARS = 4_000_000
#: Text bytes of a segment.
SEGMENT_BYTES = 8_000_000
#: A list is short if it has at most one of so many documents of the segment.
SHORT_PART = 32
#: Documents in the first window; each further one has twice as many.
FIRST_WINDOW = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Terms:
    """The terms of some items, found in texts by hash and compared by bytes."""

    def __init__(self, words: Iterable[str]) -> None:
        self.words = sorted(set(words))
        column = pa.array(self.words, pa.large_string())
        data, offsets = buffers(column)
        hashes, _ = word_hashes(data, offsets, NOT_ALNUM)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        self.sizes, self.starts = np.diff(offsets), offsets[:-1]
        self.data = np.concatenate((data, np.zeros(8, np.uint8)))

    def found(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each text; text, term and occurrences of each (text, term), by text and term."""
        data, offsets = buffers(column)
        hashes, bounds = word_hashes(data, offsets, NOT_ALNUM)
        none = np.zeros(0, np.int64)
        if not len(self.words) or not len(hashes):
            return np.diff(bounds), none, none, none
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hits = np.flatnonzero(self.hashes[at] == hashes)
        term = self.number[at[hits]]
        starts, ends = _word_places(data, offsets)
        same = self._same(_LOWER[data], starts[hits], (ends - starts)[hits], term)
        hits, term = hits[same], term[same]
        owner = np.searchsorted(bounds, hits, "right") - 1
        pairs, counts = np.unique(owner * len(self.words) + term, return_counts=True)
        return np.diff(bounds), pairs // len(self.words), pairs % len(self.words), counts

    def _same(self, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Whether the words at ``starts`` are the terms, eight bytes at a time."""
        theirs = _eights(self.data)
        ours = _eights(np.concatenate((low, np.zeros(8, np.uint8))))
        same = sizes == self.sizes[term]
        live, step = np.flatnonzero(same), 0
        while len(live):
            left = np.minimum(sizes[live] - step, 8).astype(np.uint64)
            differ = (ours[starts[live] + step] ^ theirs[self.starts[term[live]] + step]) << (np.uint64(64) - left * np.uint64(8))
            same[live[differ != 0]] = False
            step += 8
            live = live[(differ == 0) & (sizes[live] > step)]
        return same


def _eights(data: np.ndarray) -> np.ndarray:
    return np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))


def _word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; words end with their text."""
    inside = ~NOT_ALNUM[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = np.diff(offsets) > 0
    first[offsets[:-1][some]] |= inside[offsets[:-1][some]]
    last[offsets[1:][some] - 1] |= inside[offsets[1:][some] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


@dataclass
class Queries:
    """Items of a block: (item_id, term numbers, how often each occurs in the item)."""

    terms: Terms
    items: list[tuple[int | None, np.ndarray, np.ndarray]]


def query_blocks(items: DataFrame, key: str, text: str) -> Iterator[Queries]:
    """The items with a term, in blocks of at most BLOCK_CHARS characters (or one longer item)."""
    block: list[tuple[int | None, Counter]] = []
    size = 0

    def made() -> Queries:
        terms = Terms(w for _, c in block for w in c)
        number = {w: i for i, w in enumerate(terms.words)}
        return Queries(terms, [(i, np.array([number[w] for w in c]), np.array(list(c.values()), np.int64)) for i, c in block])

    rows = texts(items, key, text).select(F.col("doc_id").cast("long").alias("item"), "text")
    for row in rows.toLocalIterator():
        words = Counter(normal_words(row.text))
        if not words:
            continue
        if block and size + len(row.text) > BLOCK_CHARS:
            yield made()
            block, size = [], 0
        block.append((row.item, words))
        size += len(row.text)
    if block:
        yield made()


_SEGMENT = pa.schema([
    ("n_docs", pa.int64()), ("n_words", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("docs", pa.binary()), ("tfs", pa.binary()),
])
_SEGMENT_KINDS = "n_docs long, n_words long, doc_ids array<long>, lengths array<long>, terms array<long>, counts array<long>, docs binary, tfs binary"


def segments(docs: DataFrame, queries) -> DataFrame:  # noqa: ANN001 - a broadcast of Queries
    """The postings of the items' terms, one row for about SEGMENT_BYTES of text.

    n_docs and n_words count the documents with a word and all words; the others hold only
    documents with a term: their ids and numbers of words, and for each term its
    documents (places in doc_ids, rising) and occurrences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = queries.value.terms
        empty = lambda: {"ids": [], "lengths": [], "doc": [], "term": [], "tf": []}
        held, n_docs, n_words, kept, size = empty(), 0, 0, 0, 0

        def flushed() -> pa.RecordBatch:
            join = lambda name: np.concatenate(held[name]) if held[name] else np.zeros(0, np.int64)
            doc, term, tf = join("doc"), join("term"), join("tf")
            order = np.argsort(term, kind="stable")
            present, counts = np.unique(term, return_counts=True)
            row = {
                "n_docs": [n_docs], "n_words": [n_words], "doc_ids": [[i for part in held["ids"] for i in part]],
                "lengths": [join("lengths")], "terms": [present], "counts": [counts],
                "docs": [doc[order].astype("<i4").tobytes()], "tfs": [tf[order].astype("<i4").tobytes()],
            }
            return pa.RecordBatch.from_pydict(row, schema=_SEGMENT)

        for batch in batches:
            for a, b in pieces(batch.column("text")):
                body = batch.column("text").slice(a, b - a)
                lengths, owner, term, tf = terms.found(body)
                some, place = np.unique(owner, return_inverse=True)
                held["ids"].append(batch.column("doc_id").slice(a, b - a).take(pa.array(some)).to_pylist())
                held["lengths"].append(lengths[some])
                held["doc"].append(place + kept)
                held["term"].append(term)
                held["tf"].append(tf)
                n_docs, n_words, kept, size = n_docs + int((lengths > 0).sum()), n_words + int(lengths.sum()), kept + len(some), size + body.nbytes
                if size >= SEGMENT_BYTES:
                    yield flushed()
                    held, n_docs, n_words, kept, size = empty(), 0, 0, 0, 0
        if n_docs:
            yield flushed()

    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(base, run, _SEGMENT_KINDS)


@dataclass
class Totals:
    """Documents with a word, all words, and the weight of each term."""

    n_docs: int
    n_words: int
    weights: np.ndarray


def totals(found: DataFrame, n_terms: int) -> Totals:
    """Sums over all segments; the driver reads one number for each term of the items."""
    row = found.agg(F.sum("n_docs").alias("d"), F.sum("n_words").alias("w")).first()
    n = row["d"] or 0
    each = found.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[each.column("terms").to_numpy()] = each.column("df").to_numpy()
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df]
    return Totals(n, row["w"] or 0, np.array(weights, np.int64))


@dataclass
class Best:
    """The best documents of an item so far: scores, whether the id is null, ids; best first."""

    k: int
    scores: np.ndarray
    null: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, k: int) -> Best:
        return cls(k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """The score that a further document must reach; with it, its id decides."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        scores, null, ids = np.append(self.scores, scores), np.append(self.null, null), np.append(self.ids, ids)
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.null, self.ids = scores[order], null[order], ids[order]


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of some lists, rising, and their sums."""
    docs, place = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    for (d, s), end in zip(lists, np.cumsum([len(d) for d, _ in lists])):
        sums[place[end - len(d) : end]] += s  # a list has each document once
    return docs, sums


def search_segment(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, null: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Put into ``best`` what the segment's documents score: lists of (documents, scores) by term."""
    short = [x for x in lists if len(x[0]) * SHORT_PART <= n_docs]
    iterators = [x for x in lists if len(x[0]) * SHORT_PART > n_docs]
    if short:
        iterators.append(accumulated(short))
    iterators = sorted(((int(s.max()), d, s) for d, s in iterators), key=lambda x: x[0])
    reach = np.cumsum([0] + [x[0] for x in iterators])  # what the first ones reach together
    begin, width = 0, FIRST_WINDOW
    while begin < n_docs:
        end, least = min(begin + width, n_docs), best.least
        # the first ones together stay below the score to beat: they bring no candidate
        essential = int(np.searchsorted(reach[1:], least, "left"))
        if essential == len(iterators):
            return
        parts = []
        for _, d, s in iterators[essential:]:
            a, b = np.searchsorted(d, (begin, end))
            if a < b:
                parts.append((d[a:b], s[a:b]))
        if parts:
            docs, sums = accumulated(parts)
            for i in range(essential - 1, -1, -1):
                fit = sums + reach[i + 1] >= least
                docs, sums = docs[fit], sums[fit]
                if not len(docs):
                    break
                _, d, s = iterators[i]
                at = np.minimum(np.searchsorted(d, docs), len(d) - 1)
                sums = sums + np.where(d[at] == docs, s[at], 0)
            fit = sums >= least
            if fit.any():
                best.add(sums[fit], null[docs[fit]], ids[docs[fit]])
        begin, width = end, 2 * width


def _searched(queries, sums: Totals, k: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = queries.value.items
        best = [Best.empty(k) for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                docs, tf = np.frombuffer(row["docs"], "<i4").astype(np.int64), np.frombuffer(row["tfs"], "<i4").astype(np.int64)
                length = np.array(row["lengths"], np.int64)
                if 25 * int(length.max(initial=0)) * sums.n_docs >= 1 << 62:
                    length = length.astype(object)
                m = (100 - 25 + (25 * length * sums.n_docs) // max(sums.n_words, 1)).astype(np.int64)
                counts, terms = np.array(row["counts"], np.int64), np.array(row["terms"], np.int64)
                scores = (1_000_000_000 * tf) // (1000 * tf + 12 * m[docs]) * np.repeat(sums.weights[terms], counts)
                ends = np.cumsum(counts)
                null = np.array([i is None for i in row["doc_ids"]], bool)
                ids = np.array([i or 0 for i in row["doc_ids"]], np.int64)
                where = np.full(len(sums.weights), -1)
                where[terms] = np.arange(len(terms))
                for (_, own, times), b in zip(items, best):
                    lists = [(docs[ends[j] - counts[j] : ends[j]], scores[ends[j] - counts[j] : ends[j]] * q)
                             for j, q, t in zip(where[own].tolist(), times.tolist(), own.tolist()) if j >= 0 and sums.weights[t] > 0]
                    if lists:
                        search_segment(lists, len(ids), null, ids, b)
        for number, ((item, _, _), b) in enumerate(zip(items, best)):
            m = len(b.scores)
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * m, pa.int64()), pa.array([item] * m, pa.int64()), pa.array(b.ids, mask=b.null), pa.array(b.scores)],
                    names=["number", "item_id", "doc_id", "score"],
                )

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = BEST, key: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` documents of highest score above 0.

    Equal scores go by rising doc_id, a null doc_id comes last. Null texts have no words; an
    item without a word, or without a document that has one of its words, gives no
    row, and neither does an empty table. Every row of ``items`` is an item of its
    own, every row of ``docs`` a document, repeated ones too. Other columns are not read.
    """
    spark, out = docs.sparkSession, None
    for block in query_blocks(items, key, text):
        sent = spark.sparkContext.broadcast(block)
        found = stage(segments(docs, sent), "segments")
        sums = totals(found, len(block.terms.words))
        rows = map_arrow(found, _searched(sent, sums, k), "number long, item_id long, doc_id long, score long")
        best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        rows = rows.select("item_id", "rank", "doc_id", "score")
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
