"""Substring dedup by unit digests: lines, paragraphs, sentences of lines, or passages of sentences.

Units are normalised (lower case, runs of anything but letters and digits become one
blank) and hashed; digests are grouped over all documents. The earliest occurrence,
ranked by doc_id and place, stays; the others are removed, their offsets in the
original text are kept with the result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import joined, key_map, map_arrow, map_rows, pieces, row_key, texts
from labelmill.storage import stage

#: Units with fewer words stay where they stand alone: short ones repeat by chance.
MIN_WORDS = 8
#: Words of a repeated passage. A notice or a saying of fewer words stays where it stands among other words.
PASSAGE_WORDS = 25
SPLITS = {
    "line": re.compile(r"[^\n]+"),
    "paragraph": re.compile(r"[^\n](?:[^\n]|\n(?![ \t]*\n))*"),
    "sentence": re.compile(r"[^\s](?:[^\n.!?]|[.!?](?!\s))*[.!?]?"),
}
_other = re.compile(r"[\W_]+")
#: Scripts without blanks between words (Thai to Khmer, kana, Han); two of their characters count as a word.
_dense = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normal(text: str) -> tuple[str, int]:
    """The normalised text and its number of words."""
    plain = _other.sub(" ", text.lower()).strip()
    n = plain.count(" ") + 1 if plain else 0
    return plain, n if plain.isascii() else max(n, len(_dense.findall(plain)) // 2)


def digest(plain: str) -> bytes:
    return hashlib.md5(plain.encode("utf-8", "replace")).digest()


def units(text: str, unit: str, min_words: int) -> Iterable[tuple[int, int, bytes]]:
    """(start, end, digest) of each unit with enough words; offsets in code points.

    ``passage`` gives runs of sentences within their lines (``runs``), the others each
    line, paragraph or sentence by itself.
    """
    if unit == "passage":
        yield from runs(text, min_words)
        return
    for m in SPLITS[unit].finditer(text):
        plain, n = normal(m.group())
        if n >= min_words and plain:
            yield m.start(), m.end(), digest(plain)


def runs(text: str, min_words: int) -> Iterable[tuple[int, int, bytes]]:
    """(start, end, digest) of the shortest runs of sentences with enough words, one from and one up to each sentence.

    Every sentence of a repeated passage with enough words lies in a run inside the
    passage: in the run that ends with it, or in the one that starts with the passage.
    A sentence is normalised and hashed once; a run's digest is that of its sentences'
    digests. A text with fewer words is one unit, equal only to whole texts. What
    overlaps the first run of the same words in a text is no further occurrence.
    """
    parts = []
    for m in SPLITS["sentence"].finditer(text):
        plain, n = normal(m.group())
        if n:
            parts.append((m.start(), m.end(), n, digest(plain)))
    if not parts:
        return
    ends, total = [], 0  # words up to each sentence
    for x in parts:
        total += x[2]
        ends.append(total)
    if total < min_words:
        yield parts[0][0], parts[-1][1], hashlib.md5(b"".join(x[3] for x in parts)).digest()
        return
    found = set()
    for i, x in enumerate(parts):
        before = ends[i] - x[2]
        high = bisect_left(ends, before + min_words)
        if high < len(parts):
            found.add((i, high))
        low = bisect_right(ends, ends[i] - min_words)
        if ends[i] >= min_words:
            found.add((low, i))
    hashes = b"".join(x[3] for x in parts)
    first: dict[bytes, int] = {}
    for low, high in sorted(found, key=lambda r: (r[0], -r[1])):
        d = hashlib.md5(hashes[16 * low : 16 * high + 16]).digest()
        a, b = parts[low][0], parts[high][1]
        if d not in first or a >= first[d]:
            yield a, b, d
        first.setdefault(d, b)


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rk, n_units, removed: sorted array<struct<start, end>>) of every row.

    A null text has no unit. Rows equal in doc_id and text are one document; rows
    without doc_id rank last. Other columns are not read.
    """
    base = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    base = base.withColumn("rk", row_key(F.col("text"), F.col("doc_id")))

    def rows(keys: list, bodies: list) -> Iterable[tuple]:
        for (doc_id, rk), body in zip(keys, bodies):
            found = list(units(body, unit, min_words))
            yield doc_id, rk, [{"start": a, "end": b, "hi": int.from_bytes(d[:8], "big", signed=True), "lo": int.from_bytes(d[8:], "big", signed=True)} for a, b, d in found]

    item = pa.struct([(n, pa.int64()) for n in ("start", "end", "hi", "lo")])
    keyed = base.select(F.struct("doc_id", "rk").alias("doc_id"), "text")
    kinds = "doc_id long, rk long, units array<struct<start:long,end:long,hi:long,lo:long>>"
    found = map_rows(keyed, lambda k, t: rows([(x["doc_id"], x["rk"]) for x in k], t), kinds, ["doc_id", "rk", "units"], [pa.int64(), pa.int64(), pa.list_(item)])
    found = stage(found, "units")
    every = found.select("doc_id", "rk", F.explode("units").alias("u")).select("doc_id", "rk", "u.*")
    again = stage(every.groupBy("hi").count().where("count > 1").select("hi"), "again")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rk", "start")
    first = every.where(key_map(again, "hi")("hi")).groupBy("hi", "lo").agg(F.min(order).alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stage(first, "first")
    gone = every.where(key_map(first, "hi", "lo")("hi", "lo")).join(first, ["hi", "lo"]).where(~order.eqNullSafe(F.col("keep")))
    gone = gone.groupBy("doc_id", "rk").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed"))
    gone = gone.select(F.col("doc_id").alias("id"), F.col("rk").alias("key"), "removed")
    out = found.select("doc_id", "rk", F.size("units").cast("long").alias("n_units"))
    out = out.join(gone, (out.rk == gone.key) & out.doc_id.eqNullSafe(gone.id), "left")
    return out.select("doc_id", "rk", "n_units", F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"))


def drop_repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_units, removed (maximal runs, offsets in the original) and the remaining text of every row."""
    found = repeated_units(docs, unit, min_words).distinct()
    own = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("own", row_key(F.col("text"), F.col("doc_id")))
    found = found.select(F.col("doc_id").alias("id"), "rk", "n_units", "removed")
    both = own.join(found, (own.own == found.rk) & own.doc_id.eqNullSafe(found.id))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_units", pa.int64()), ("removed", spans), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                part, left, shown = batch.slice(a, b - a), [], []
                for text, runs in zip(part.column("text").to_pylist(), part.column("removed").to_pylist()):
                    gone = joined([(r["start"], r["end"]) for r in runs])
                    edges = [0, *(x for r in gone for x in r), len(text)]
                    left.append("".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    shown.append([{"start": x, "end": y} for x, y in gone])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_units"), pa.array(shown, spans), pa.array(left, pa.string())], schema=schema)

    kinds = "doc_id long, n_units long, removed array<struct<start:long,end:long>>, text string"
    return map_arrow(both.select("doc_id", "n_units", "removed", "text"), run, kinds)
