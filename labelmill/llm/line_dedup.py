"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash over the hashes of two consecutive lines chooses where a chunk ends: where
it is less than the one before and not greater than the next. Two such places never
follow each other, so every chunk has two lines at least, and an inserted or removed
line shifts only the chunks around it. Chunks that occur again anywhere are grouped by
their bytes; the earliest occurrence (by doc_id, then place) stays, the lines of
the others go, and with them the lines next to them that are also next to the one that stays.

Line and chunk hashes are shuffled, not texts. Only texts with a chunk whose hash occurs
twice are joined, and their chunks are compared by bytes: equal hashes of different
chunks remove nothing. A last join takes the texts that lose lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import key_map, narrow, place, row_key, texts, wide
from labelmill.storage import stage

#: Weight of the earlier line in the rolling hash, and the number of its values.
FACTOR, VALUES = 31, 1_000_003


def line_hash(line: Column) -> Column:
    """The first 32 bits of a line's md5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def chunk_bounds(text: Column) -> Column:
    """array<struct<first, last>>: the lines of each chunk, counted from 0."""
    hashes = F.transform(F.split(text, "\n"), line_hash)

    def rolled(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.pmod(F.get(h, i - 1) * FACTOR + x, F.lit(VALUES)))

    def ends(r: Column) -> Column:
        last = F.size(r) - 1
        # the first line has no rolling hash: the second may end a chunk whatever comes before
        low = lambda i: F.coalesce(F.get(r, i) < F.get(r, i - 1), F.lit(True)) & (F.get(r, i) <= F.get(r, i + 1))
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ((i > 0) & (i < last - 1) & low(i)))

    def chunks(e: Column) -> Column:
        return F.transform(e, lambda x, k: F.struct((F.coalesce(F.get(e, k - 1), F.lit(-1)) + 1).alias("first"), x.alias("last")))

    return named(named(named(hashes, rolled), ends), chunks)


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def line_range(lines: Column, first: Column, last: Column) -> Column:
    return F.slice(lines, first + 1, last - first + 1)


def chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(line_range(lines, chunk["first"], chunk["last"]), "\n")


def _order(doc_id: str = "doc_id") -> list[Column]:
    return [F.col(doc_id).isNull().alias("late"), F.col(doc_id), F.col("rk"), F.col("first")]


def _alike(mine: Column, theirs: Column) -> Column:
    """How many leading entries of two arrays are equal."""
    differs = F.array_position(F.zip_with(mine, theirs, lambda a, b: a.eqNullSafe(b)), F.lit(False))
    return F.when(differs == 0, F.size(mine)).otherwise(differs - 1).cast("int")


def runs_of(numbers: Column) -> Column:
    """Sorted distinct numbers as array<struct<first, last>> of neighbours."""

    def ranges(x: Column) -> Column:
        starts = F.filter(x, lambda v, i: (i == 0) | (F.get(x, i - 1) != v - 1))
        stops = F.filter(x, lambda v, i: (i == F.size(x) - 1) | (F.get(x, i + 1) != v + 1))
        return F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("first"), b.alias("last")))

    return named(numbers, ranges)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, removed: sorted array<struct<first, last>>) of the documents that lose lines.

    Null texts and texts of one line have no chunk; chunks without any word stay. Lines
    next to a repeated chunk go only out of chunks that do not occur again themselves.
    Rows equal in doc_id and text are one document. Rows without doc_id come last in
    the order of occurrences. An empty table loses nothing.
    """
    base = texts(docs).withColumn("rk", row_key(F.col("text"), F.col("doc_id")))
    lines = F.split("text", "\n")

    def around(chunks: Column) -> Column:
        """Chunks of several lines, each with the bounds of its neighbours."""
        with_neighbours = F.transform(chunks, lambda c, k: F.struct(
            c["first"].alias("first"), c["last"].alias("last"),
            F.coalesce(F.get(chunks, k - 1)["first"], c["first"]).alias("from"), F.coalesce(F.get(chunks, k + 1)["last"], c["last"]).alias("to"),
        ))
        return F.filter(with_neighbours, lambda c: c["last"] > c["first"])

    cut = base.select("doc_id", "rk", lines.alias("lines"), named(chunk_bounds(F.col("text")), around).alias("chunks"))
    hashed = cut.select("doc_id", "rk", F.explode(F.transform("chunks", lambda c: F.struct(c.alias("c"), F.xxhash64(chunk_text(F.col("lines"), c)).alias("hash")))).alias("x"))
    chunk_rows = stage(hashed.select("doc_id", "rk", "x.c.*", "x.hash").distinct(), "chunks")
    again = chunk_rows.groupBy("hash").count().where("count > 1").select("hash")
    fields = ("first", "last", "from", "to", "hash")
    found = chunk_rows.join(again, "hash").groupBy("doc_id", "rk").agg(F.collect_list(F.struct(*fields)).alias("found"))
    found = stage(found.select(F.col("doc_id").alias("id"), F.col("rk").alias("key"), "found"), "found")

    # texts with such a chunk; equal rows give equal parts, which the least and the greatest place tell apart
    own = base.where(key_map(found, "key")("rk"))
    parts = own.join(found, (F.col("rk") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")))
    parts = parts.select("doc_id", "rk", lines.alias("lines"), "found", F.explode("found").alias("c"))
    digests = lambda first, last: F.transform(line_range(F.col("lines"), first, last), lambda x: F.unhex(F.sha2(x, 256)))
    free = lambda met: ~F.exists("found", met)
    parts = parts.select(
        "doc_id", "rk", "c.first", "c.last", "c.hash", chunk_text(F.col("lines"), F.col("c")).alias("body"),
        F.reverse(digests(F.col("c.from"), F.col("c.first") - 1)).alias("before"), digests(F.col("c.last") + 1, F.col("c.to")).alias("after"),
        free(lambda r: r["last"] == F.col("c.first") - 1).alias("free_before"), free(lambda r: r["first"] == F.col("c.last") + 1).alias("free_after"),
    )
    parts = parts.where(F.col("body").rlike(r"[^\x20\x09-\x0D]"))
    parts = stage(parts.withColumn("digest", F.sha2("body", 256)), "bodies")
    place_of = F.struct(*_order())
    earliest = parts.groupBy("hash", "digest", "body").agg(
        F.min(F.struct(place_of.alias("at"), "before", "after")).alias("keep"), F.max(place_of).alias("end")
    ).where("keep.at <> end")
    earliest = earliest.select("hash", "digest", F.col("keep.at").alias("at"), F.col("keep.before").alias("b"), F.col("keep.after").alias("a"))
    rest = parts.drop("body").join(earliest, ["hash", "digest"]).where(~F.struct(*_order()).eqNullSafe(F.col("at")))
    first = F.col("first") - F.when(F.col("free_before"), _alike(F.col("before"), F.col("b"))).otherwise(0)
    last = F.col("last") + F.when(F.col("free_after"), _alike(F.col("after"), F.col("a"))).otherwise(0)
    gone = rest.groupBy("doc_id", "rk").agg(F.collect_list(F.sequence(first, last)).alias("gone"))
    return stage(gone.select("doc_id", "rk", runs_of(F.array_sort(F.array_distinct(F.flatten("gone")))).alias("removed")), "removed")


def drop_repeated_chunks(docs: DataFrame, details: bool = False) -> DataFrame:
    """The documents without repeated chunks; every row stays, with its other columns.

    A text that loses all its lines becomes empty, n_chars (if there) follows the
    text. With ``details``, columns removed (array of line ranges) and n_lines are
    added; n_lines is 0 for a null text.
    """
    own, names = wide(docs)
    doc_id, text = F.col(place(names, "doc_id")), F.col(place(names, "text"))
    own = own.withColumn("lm_key", row_key(F.coalesce(text.cast("string"), F.lit("")), doc_id))
    gone = repeated_chunks(docs).select(F.col("doc_id").alias("lm_id"), F.col("rk").alias("lm_rk"), F.col("removed").alias("lm_removed"))
    # only texts that may lose lines are moved
    touched = key_map(gone, "lm_rk")("lm_key")
    out = own.where(touched).join(gone, (F.col("lm_key") == F.col("lm_rk")) & doc_id.eqNullSafe(F.col("lm_id")), "left")
    out = out.unionByName(own.where(~touched), allowMissingColumns=True)
    removed = F.col("lm_removed")

    def remaining(lines: Column) -> Column:
        edges = F.concat(F.transform(removed, lambda r: r["first"]), F.array(F.size(lines)))
        after = lambda i: F.coalesce(F.get(removed, i - 1)["last"] + 1, F.lit(0))
        return F.flatten(F.transform(edges, lambda e, i: F.slice(lines, after(i) + 1, e - after(i))))

    left = named(F.split(text, "\n"), remaining)
    new = {place(names, "text"): F.when(removed.isNull(), text).otherwise(F.array_join(left, "\n"))}
    if "n_chars" in names:
        n = F.col(place(names, "n_chars"))
        new[place(names, "n_chars")] = F.when(removed.isNull(), n).otherwise(F.length(F.array_join(left, "\n")).cast(docs.schema["n_chars"].dataType))
    if not details:
        return narrow(out.withColumns(new), names)
    new["lm_lines"] = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    out = out.withColumns(new).select(*[F.col(f"lm_{i}") for i in range(len(names))], "lm_removed", "lm_lines")
    return out.toDF(*names, "removed", "n_lines")
