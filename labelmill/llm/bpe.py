"""Byte-level BPE encoding and decoding by longest matches and pair compatibility.

A sequence of tokens is the one that merging by rank gives exactly if every two
neighbours are compatible, that is if merging their own bytes gives them again. So
the longest matches of an Aho-Corasick automaton over all tokens (bytes as Latin-1
characters) are taken first, for all pieces of a batch in one scan. Pieces in which two
neighbours are not compatible are backtracked: the last token is replaced by its
longest prefix that is a token, and a place from which nothing went on is never tried
again, which keeps the time linear in the piece. Compatibility is read off the
merge steps on both sides of the border and memoised.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, count

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import map_arrow, pieces, texts

#: A character that no byte maps to; it ends every match at the end of a piece.
BETWEEN = "Ā"
#: Pairs whose compatibility a worker remembers before it starts afresh.
MEMO = 1 << 19
#: Pieces of at most SHORT characters whose ids a worker remembers; twice as many at most.
PIECES, SHORT = 1 << 19, 64
#: Bytes of text that are encoded at a time.
PART_BYTES = 1_000_000
NEVER = 1 << 62


class Vocabulary:
    """Encodes by merge ranks (bytes -> id, in the order of the merges) within pieces of ``pattern``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.whole: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            latin = token.decode("latin-1")
            if len(token) > 1:
                parts = self._merged(token, i)
                if len(parts) != 2:
                    if len(self._merged(token, NEVER)) == 1:
                        raise ValueError(f"ranks are not in the order of merges: {token!r}")
                    # merging never makes this token: only a piece equal to it has it
                    self.whole[latin] = i
                    continue
                self.halves[i] = parts[0], parts[1]
            self.automaton.add_word(latin, (i, len(token)))
        self.automaton.make_automaton()
        usable = {t: i for t, i in ranks.items() if len(t) == 1 or i in self.halves}
        #: The longest token that is a proper prefix.
        self.shorter = {i: next((usable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), None) for t, i in usable.items()}
        self.size_of = {i: len(t) for i, t in self.bytes_of.items()}
        self.memo: dict[int, bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _merged(self, token: bytes, limit: int) -> list[int]:
        """Ids after all merges of rank below ``limit``, lowest rank first, then leftmost."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= limit:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives the two tokens again."""
        key = left << 32 | right
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[key] = self._holds(left, right)
        return known

    def _holds(self, left: int, right: int) -> bool:
        # Back through the merges on both sides of the border, the latest first. Tokens
        # that touch there at some time must not merge before either is merged away;
        # of equal ranks the one further left goes first.
        until_left = until_right = NEVER
        made = lambda i: i if i in self.halves else -1
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], NEVER)
            if across < until_left and across <= until_right and across != NEVER:
                return False
            if made(left) < 0 and made(right) < 0:
                return True
            if made(left) > made(right):
                until_left, left = left, self.halves[left][1]
            else:
                until_right, right = right, self.halves[right][0]

    def _backtracked(self, latin: str, greedy: list[int], ok: int) -> list[int]:
        """Ids of one piece whose longest matches are compatible up to the one before place ``ok``."""
        size_of, shorter, known, whole = self.size_of, self.shorter, self.memo.get, len(latin)
        out = greedy[:ok]
        at, token = sum(map(size_of.__getitem__, out)), shorter[greedy[ok]]
        longest: list[int] | None = None
        alive = bytearray(b"\1") * (whole + 1)
        while True:
            while token is None:
                # nothing goes on from here: shorten the token that led here
                alive[at] = 0
                token = out.pop()
                at -= size_of[token]
                token = shorter[token]
            end = at + size_of[token]
            if alive[end] and (not out or known(out[-1] << 32 | token) or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == whole:
                    return out
                if longest is None:
                    longest = [-1] * whole
                    for stop, (i, n) in self.automaton.iter(latin):
                        longest[stop - n + 1] = i  # of one start, longer matches end later
                token = longest[at]
            else:
                token = shorter[token]

    def encode_pieces(self, bodies: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        latin = [p.encode("utf-8", "replace").decode("latin-1") for p in bodies]
        stop = np.cumsum(np.fromiter((len(x) + 1 for x in latin), np.int64, len(latin))) - 1  # each piece's separator
        found = list(self.automaton.iter_long(BETWEEN.join(latin)))
        ids = [v[0] for _, v in found]
        bounds = [0, *np.searchsorted(np.fromiter((e for e, _ in found), np.int64, len(found)), stop).tolist()]
        known, out = self.memo.get, []
        for x, a, b in zip(latin, bounds, bounds[1:]):
            greedy = ids[a:b]
            if x in self.whole:
                greedy = [self.whole[x]]
            else:
                for i in range(1, b - a):
                    if not (known(greedy[i - 1] << 32 | greedy[i]) or self.compatible(greedy[i - 1], greedy[i])):
                        greedy = self._backtracked(x, greedy, i)
                        break
            out.append(greedy)
        return out

    def encode_batch(self, bodies: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text; equal pieces are encoded once, also over batches while they are remembered."""
        split = [self.pattern.findall(t) for t in bodies]
        number: dict[str, int] = defaultdict(count().__next__)
        codes = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64)
        known = self.pieces
        found = list(map(known.get, number))
        new = [p for p, i in zip(number, found) if i is None]
        # what is in use is carried over when the others are forgotten
        old = self.older
        later = [p for p in new if p not in old]
        fresh = dict(zip(later, self.encode_pieces(later)))
        fresh |= {p: old[p] for p in new if p in old}
        ids = [fresh[p] if i is None else i for p, i in zip(number, found)]
        known.update((p, i) for p, i in fresh.items() if len(p) <= SHORT)
        if len(known) > PIECES:
            self.older, self.pieces = known, {}
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        bounds, flat = np.cumsum(sizes) - sizes, np.fromiter(chain.from_iterable(ids), "<u4")
        counts = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(counts)))
        flat = flat[np.repeat(bounds[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        cuts = ends[np.cumsum([0, *map(len, split)])]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def decoded(ids: np.ndarray, bytes_of: dict[int, bytes]) -> bytes:
    """The bytes of all ids; an unknown id raises."""
    return b"".join(map(bytes_of.__getitem__, ids.tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """From a file with a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def vocabulary(ranks: str, pattern: str | None = None) -> Vocabulary:
    """The vocabulary of a file, by default with the installed pattern."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern  # noqa: N811
    return Vocabulary(read_ranks(ranks), pattern)


@lru_cache(maxsize=2)
def token_bytes(ranks: str) -> dict[int, bytes]:
    return {i: t for t, i in read_ranks(ranks).items()}


def encode(docs: DataFrame, ranks: str, pattern: str | None = None, decoding: bool = False) -> DataFrame:
    """doc_id and ids (binary, little-endian uint32) of every row's whole text.

    No special token is added or recognised. A null or empty text has no ids; repeated
    rows stay; other columns are not read; an empty table gives no rows. ``ranks`` is
    a path that every worker can read. ``decoding`` decodes the ids in the same pass, as
    ``decode`` does, into a further column ``decoded``.
    """
    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            for a, b in pieces(batch.column("text"), PART_BYTES):
                ids = words.encode_batch(batch.column("text")[a:b].to_pylist())
                columns = {"doc_id": batch.column("doc_id").slice(a, b - a), "ids": pa.array([x.tobytes() for x in ids], pa.binary())}
                if decoding:
                    columns["decoded"] = pa.array([decoded(x, words.bytes_of) for x in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return map_arrow(base, run, "doc_id long, ids binary" + ", decoded binary" * decoding)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and decoded (binary) of rows with ids; null ids decode to null, unknown ones raise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = token_bytes(ranks)
        for batch in batches:
            out = [None if x is None else decoded(np.frombuffer(x, "<u4"), words) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], names=["doc_id", "ids", "decoded"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary")
