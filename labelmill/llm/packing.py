"""Best-fit decreasing packing of tokenised documents into sequences of one length.

A document longer than a window is first cut into full windows; the rests are
packed best-fit decreasing: a segment tree over remaining capacities answers which
open window leaves the least room. One pass tokenises and cuts, into a written table;
the rests are then packed in tasks of some million tokens each, read from it without
a shuffle, so only the last windows of so many tokens stay partly empty. Memory is
bounded by the rests of a task.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import map_arrow, pieces, texts
from labelmill.storage import stage_counted

WINDOW = 1024
#: Tokens of rests that a task packs together, at least.
PACKED_TOKENS = 4_000_000
#: This bit tells sequences of rests from those of full windows.
RESTS = 1 << 62


class OpenWindows:
    """Segment tree over capacities 0…size: how many open windows have that much room."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_room: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.by_room[room].append(window)
            self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take the window of least room >= length: (window, room)."""
        node = self.leaves + length
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        self._add(room, -1)
        return self.by_room[room].pop(), room


def best_fit_decreasing(lengths: Iterable[int], size: int) -> tuple[list[tuple[int, int]], int]:
    """(window, offset) of each piece in the given order, and the number of windows.

    Longer pieces are placed first; of equally long ones the earlier.
    """
    lengths = list(lengths)
    tree, places, n = OpenWindows(size), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.tightest(lengths[i])
        if found is None:
            found, n = (n, size), n + 1
        window, room = found
        places[i] = (window, size - room)
        tree.put(window, room - lengths[i])
    return places, n


class Encoder:
    """Ids of a tokenizer file of the ``tokenizers`` library, as uint32.

    For a byte-level BPE file whose ranks are given as well (``ranks``, the same
    vocabulary) tiktoken does the merges, about four times as fast. Texts with a
    special token's name are encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str, ranks: str | None) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.names = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.merges = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.merges = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def exact(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> np.ndarray:
        if self.merges is None or any(n in text for n in self.names):
            return self.exact(text)
        return np.array(self.merges.encode_ordinary(text), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, ranks)


FIELDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
]
KINDS = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), FIELDS)], schema=pa.schema(FIELDS))


def _cut(tokenizer: str, ranks: str | None, window: int, end_id: int):
    """Full windows, each a sequence of its own, and rests, which have no sequence yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, ranks).encode, np.array([end_id], "<u4")
        base_id, used = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                rows = []
                for doc_id, text in zip(batch.column("doc_id")[a:b].to_pylist(), batch.column("text")[a:b].to_pylist()):
                    ids = np.concatenate((encode(text), end))
                    n = len(ids)
                    for start in range(0, n, window):
                        length = min(window, n - start)
                        full = length == window
                        rows.append((doc_id, start, length, n, base_id + used if full else None, 0 if full else None, ids[start : start + length].tobytes()))
                        used += full
                yield _table(rows)

    return run


def _packed(window: int):
    """The rests of one partition in sequences, some million tokens at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, used = [], 0, RESTS | TaskContext.get().partitionId() << 40

        def flushed() -> Iterator[pa.RecordBatch]:
            lengths = [n for batch in held for n in batch.column("length").to_pylist()]
            places, at = best_fit_decreasing(lengths, window)[0], 0
            for batch in held:
                here = places[at : at + len(batch)]
                at += len(batch)
                columns = {name: batch.column(name) for name, _ in FIELDS}
                columns["sequence_id"] = pa.array([used + w for w, _ in here], pa.int64())
                columns["offset"] = pa.array([o for _, o in here], pa.int64())
                yield pa.RecordBatch.from_pydict(columns, schema=pa.schema(FIELDS))

        for batch in batches:
            held.append(batch)
            tokens += sum(batch.column("length").to_pylist())
            if tokens >= 2 * PACKED_TOKENS:
                yield from flushed()
                used += sum(len(b) for b in held)  # more than the windows they took
                held, tokens = [], 0
        yield from flushed()

    return run


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone.
    ids holds little-endian uint32, sequence_id is unique over the result, a
    sequence's pieces fill it from offset 0 without a gap. Every row is a document,
    repeated rows included. Other columns are not read; an empty table gives no rows.
    """
    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    cut = map_arrow(base, _cut(tokenizer, ranks, window, end_id), KINDS)
    rest = F.col("sequence_id").isNull()
    cut, seen = stage_counted(cut, "pieces", tokens=F.sum(F.when(rest, F.col("length"))))
    # however the documents were dealt, the rests that are packed together are enough to fill their sequences
    tasks = max(1, (seen["tokens"] or 0) // PACKED_TOKENS)
    rests = map_arrow(cut.where(rest).coalesce(tasks), _packed(window), KINDS)
    return cut.where(~rest).unionByName(rests)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids, fill and ids (little-endian uint32) of each packed sequence.

    A sequence has at most a window's tokens, so no group is long; no pieces, no rows.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids", "length")))
    out = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return out.select(
        "sequence_id", F.col("parts.doc_id").alias("doc_ids"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("fill"),
        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
    )
