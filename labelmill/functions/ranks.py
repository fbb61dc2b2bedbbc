"""Exact order statistics without sorting or collecting a whole column.

Each column is summarised by a mergeable KLL sketch with its count; the sketches of all
columns come from one scan and are merged over groups of tasks. A wanted rank lies
between two values of its sketch, a few thousandths of the rows apart. A second scan
counts the rows below exactly and reads the values between, grouped and counted, so a
value that holds a third of the rows is one row of the answer. Only if more rows lie
between than the driver may read, the rows between are summarised anew, with the
exact counts in the same scan. The driver holds some hundred numbers for each rank,
never a column. Tables of every size take this one way.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions.columns import ROW_ID, nan_to_null, one_zero
from labelmill.storage import stage_counted

# Rows between sketch values, over all columns, that the driver may read.
BRACKET_ROWS = 50_000
# Size of a sketch, and twice the rank error it keeps to with 99 % confidence.
SKETCH_K = 4096
MARGIN = 2 * 2.296 / SKETCH_K**0.9723
# Quantiles read from a sketch.
GRID = 1000
# Groups of tasks whose sketches are merged before the last merge.
MERGE_GROUPS = 64
# Leading bytes of a text that stand for it as a number in its order.
PREFIX_BYTES = 7
ACCURACY = 10_000


@dataclass
class Found:
    """Value at a rank, with the number of rows below and equal to it."""

    value: object
    below: int
    equal: int


@dataclass
class _Bracket:
    """Open interval (lo, hi) that holds a rank: rows up to lo, rows inside, and values to cut it at."""

    column: str
    rank: int
    below: int
    inside: int
    lo: object = None
    hi: object = None
    ends: tuple | None = None
    wide: bool = False  # more between the ends than could be read

    def within(self, lo: object, hi: object) -> Column:
        col = F.col(self.column)
        cond = col.isNotNull()
        if lo is not None:
            cond = cond & (col > F.lit(lo))
        return cond & (col < F.lit(hi)) if hi is not None else cond

    def cut(self, at: Sequence[int], grid: dict[tuple, list]) -> Found | None:
        """Narrow to the side of the ends that holds the rank, given the rows below, at, between, at them."""
        lo, hi = self.ends
        below, at_lo, between, at_hi = at
        r, self.ends, self.wide = self.rank - self.below, None, False
        if r < below:
            self.hi, self.inside = lo, below
        elif r < below + at_lo:
            return Found(lo, self.below + below, at_lo)
        elif r < below + at_lo + between:
            self.below, self.inside, self.lo, self.hi = self.below + below + at_lo, between, lo, hi
            self.propose(grid.get((self.column, lo, hi)))
        elif r < below + at_lo + between + at_hi:
            return Found(hi, self.below + below + at_lo + between, at_hi)
        else:
            seen = below + at_lo + between + at_hi
            self.below, self.inside, self.lo = self.below + seen, self.inside - seen, hi
        return None

    def propose(self, grid: list | None) -> None:
        """Two values of the sketch of this interval around the rank."""
        if grid:
            at = (self.rank - self.below) / self.inside
            first = math.floor((at - MARGIN) * GRID) - 1
            last = math.ceil((at + MARGIN) * GRID) + 1
            self.ends = grid[max(first, 0)], grid[min(last, GRID)]


def _one_row(df: DataFrame, exprs: Mapping[str, Column]) -> dict:
    return df.agg(*[e.alias(name) for name, e in exprs.items()]).first().asDict()


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns as whole numbers or doubles, without -0.0."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    kind = {c: "bigint" if isinstance(df.schema[c].dataType, whole) else "double" for c in cols}
    return one_zero(df.select(*[F.col(c).cast(kind[c]).alias(c) for c in cols]), cols)


def _summaries(df: DataFrame, wanted: Mapping[tuple, Column], counts: Mapping[str, Column] | None = None) -> tuple[dict[tuple, tuple[int, list]], dict]:
    """(rows, quantiles on the grid) of each (column, lo, hi) with its condition, and sums of flags: one scan.

    Sketches are merged over groups of tasks first, so that no task merges those of all.
    """
    kinds = {c: "bigint" if isinstance(df.schema[c].dataType, T.LongType) else "double" for c, _, _ in wanted}
    sketch = {"bigint": (F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint),
              "double": (F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double)}
    counts = counts or {}
    first, last, shown = [], [], []
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    for i, ((column, _, _), cond) in enumerate(wanted.items()):
        make, merge, read = sketch[kinds[column]]
        value = F.when(cond, F.col(column))
        first += [F.count(value).alias(f"n{i}"), make(value, SKETCH_K).alias(f"s{i}")]
        last += [F.sum(f"n{i}").alias(f"n{i}"), merge(f"s{i}", SKETCH_K).alias(f"s{i}")]
        shown += [F.col(f"n{i}"), F.when(F.col(f"n{i}") > 0, read(f"s{i}", grid)).alias(f"q{i}")]
    for name, flag in counts.items():
        first.append(F.count_if(flag).alias(name))
        last.append(F.sum(name).alias(name))
        shown.append(F.col(name))
    groups = df.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS).groupBy("_group").agg(*first)
    row = groups.agg(*last).select(*shown).first().asDict()
    found = {key: (row[f"n{i}"] or 0, row[f"q{i}"]) for i, key in enumerate(wanted)}
    return found, {name: row[name] or 0 for name in counts}


def _read(df: DataFrame, brackets: Sequence[_Bracket], most: int) -> tuple[dict[str, list], dict[tuple, int]] | None:
    """(value, rows) between the ends, or inside a bracket without ends; and the rows below each lower end.

    One scan: a value is kept as it is where some bracket reads it, and counted by the
    number of lower ends up to it elsewhere. None if there are more than ``most``.
    """
    by_column: dict[str, list[_Bracket]] = defaultdict(list)
    for b in brackets:
        by_column[b.column].append(b)
    cells, lower = [], {}
    for i, (c, mine) in enumerate(by_column.items()):
        col = F.col(c)
        lower[c] = sorted({b.ends[0] for b in mine if b.ends})
        kept = None
        for b in mine:
            cond = (col >= F.lit(b.ends[0])) & (col <= F.lit(b.ends[1])) if b.ends else b.within(b.lo, b.hi)
            kept = cond if kept is None else kept | cond
        passed = F.lit(0)
        for end in lower[c]:
            passed = passed + (col >= F.lit(end)).cast("int")
        whole = isinstance(df.schema[c].dataType, T.LongType)
        none = F.lit(None)
        cells.append(F.struct(
            F.lit(i).alias("c"), F.when(~kept, passed).alias("gap"),
            (F.when(kept, col) if whole else none).cast("bigint").alias("l"),
            (none if whole else F.when(kept, col)).cast("double").alias("d"),
        ))
    slots = df.select(F.inline(F.array(*cells))).where("gap IS NOT NULL OR l IS NOT NULL OR d IS NOT NULL")
    rows = slots.groupBy("c", "gap", "l", "d").count().limit(most + 1).collect()
    if len(rows) > most:
        return None
    values: dict[str, list] = {c: [] for c in by_column}
    below: dict[tuple, int] = {(c, end): 0 for c in by_column for end in lower[c]}
    names = list(by_column)
    for r in rows:
        c = names[r["c"]]
        v = r["l"] if r["l"] is not None else r["d"]
        if r["gap"] is None:
            values[c].append((v, r["count"]))
        for j, end in enumerate(lower[c]):
            if (r["gap"] is not None and r["gap"] <= j) or (r["gap"] is None and v < end):
                below[c, end] += r["count"]
    return {c: sorted(v) for c, v in values.items()}, below


def _settle(b: _Bracket, values: list, below: Mapping[tuple, int]) -> Found | None:
    """Find the rank among the values read, or narrow the bracket to where it is."""
    if not b.ends:
        at = b.below
        for v, n in values:
            if (b.lo is None or v > b.lo) and (b.hi is None or v < b.hi):
                if b.rank < at + n:
                    return Found(v, at, n)
                at += n
        raise AssertionError("a rank beyond the rows of its bracket")
    lo, hi = b.ends
    at = below[b.column, lo]
    if b.rank >= at:
        for v, n in values:
            if lo <= v <= hi:
                if b.rank < at + n:
                    return Found(v, at, n)
                at += n
        b.inside, b.below, b.lo = b.inside - (at - b.below), at, hi
    else:
        b.inside, b.hi = at - b.below, lo
    b.ends = None
    return None


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[tuple[str, int], Found]:
    """Value at each 0-based rank of each numeric column, nulls left out; see ``search_ranks``."""
    return search_ranks(df, ranks, None, counts, bracket_rows)[0]


def search_ranks(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    fractions: Mapping[str, Sequence[float]] | None = None,
    counts: Mapping[str, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> tuple[dict[tuple[str, int], Found], dict[str, int]]:
    """Value at each 0-based rank of each numeric column, nulls left out; and the present values.

    ``fractions`` adds the ranks on both sides of f * (present - 1). Ranks beyond the
    number of present values are left out of the result. ``counts`` may give the present
    values: then columns with few are read at once. ``df`` is scanned twice, further
    times only for very many rows.
    """
    fractions = fractions or {}
    cols = list(dict.fromkeys([*ranks, *fractions]))
    df = _numbers(df, cols)
    share = max(1, bracket_rows // max(1, sum(len(set(ranks.get(c, ()))) + len(fractions.get(c, ())) for c in cols)))
    grids: dict[tuple, list] = {}
    counts = dict(counts or {})
    unknown = {(c, None, None): F.col(c).isNotNull() for c in cols if counts.get(c, share + 1) > share}
    if unknown:
        seen, _ = _summaries(df, unknown)
        for (c, _, _), (n, grid) in seen.items():
            counts[c], grids[c, None, None] = n, grid
    wanted = {(c, r) for c in ranks for r in ranks[c]}
    for c, some in fractions.items():
        wanted |= {(c, g(f * (counts[c] - 1))) for f in some if counts[c] for g in (math.floor, math.ceil)}
    open_ = {key: _Bracket(*key, 0, counts[key[0]]) for key in sorted(wanted) if 0 <= key[1] < counts[key[0]]}
    for b in open_.values():
        if b.inside > share:
            b.propose(grids.get((b.column, None, None)))
    found: dict[tuple, Found] = {}
    while open_:
        readable = {
            k: b for k, b in open_.items()
            if b.inside <= share or (b.ends and not b.wide and b.inside * 2 * (MARGIN + 2 / GRID) <= share)
        }
        got = _read(df, list(readable.values()), 4 * bracket_rows + 2 * len(readable) + 10) if readable else None
        if got:
            for k, b in readable.items():
                hit = _settle(b, got[0][b.column], got[1])
                if hit:
                    found[k] = hit
        else:
            for b in readable.values():
                b.wide = True
        open_ = {k: b for k, b in open_.items() if k not in found}
        rest = {k: b for k, b in open_.items() if k not in readable or not got}
        if rest:
            _narrow(df, rest, found)
            open_ = {k: b for k, b in open_.items() if k not in found}
    return found, counts


def _narrow(df: DataFrame, open_: Mapping[tuple, _Bracket], found: dict[tuple, Found]) -> None:
    """Exact counts around the ends of each bracket and a new sketch of what lies between: one scan."""
    wanted, flags = {}, {}
    for i, b in enumerate(open_.values()):
        if b.ends is None:
            wanted[b.column, b.lo, b.hi] = b.within(b.lo, b.hi)
            continue
        lo, hi = b.ends
        col, inside = F.col(b.column), b.within(b.lo, b.hi)
        wanted[b.column, lo, hi] = b.within(lo, hi)
        flags[f"a{i}"] = inside & (col < F.lit(lo))
        flags[f"b{i}"] = col == F.lit(lo)
        flags[f"d{i}"] = (col == F.lit(hi)) & F.lit(lo != hi)
    seen, sums = _summaries(df, wanted, flags)
    grids = {key: grid for key, (_, grid) in seen.items()}
    for i, (k, b) in enumerate(open_.items()):
        if b.ends is None:
            b.propose(grids[b.column, b.lo, b.hi])
            continue
        hit = b.cut((sums[f"a{i}"], sums[f"b{i}"], seen[b.column, *b.ends][0], sums[f"d{i}"]), grids)
        if hit:
            found[k] = hit


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    fractions: Sequence[float],
    method: str = "exact",
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None for an empty column. NaN is missing."""
    cols = list(cols)
    if not cols:
        return {}
    df = nan_to_null(df.select(*cols))
    if method == "approx":
        row = _one_row(
            df, {c: F.percentile_approx(F.col(c).cast("double"), list(fractions)) for c in cols}
        )
        return {c: row[c] or [None] * len(fractions) for c in cols}
    found, counts = search_ranks(df, {}, {c: fractions for c in cols}, None, bracket_rows)
    result: dict[str, list[float | None]] = {}
    for c in cols:
        result[c] = [None] * len(fractions)
        for i, f in enumerate(fractions if counts[c] else ()):
            at = f * (counts[c] - 1)
            low = float(found[c, math.floor(at)].value)
            high = float(found[c, math.ceil(at)].value)
            result[c][i] = low + (high - low) * (at - math.floor(at))
    return result


def _cut_condition(df: DataFrame, key: str, id_col: str, size: int, at: Found) -> Column:
    """Condition met by exactly the first ``size`` rows by (key, id)."""
    col = F.col(key)
    take = size - at.below
    if take == at.equal:
        return col <= F.lit(at.value)
    tied = df.where(col == F.lit(at.value)).select(id_col)
    found = order_statistics(tied, {id_col: [take - 1]}, {id_col: at.equal})
    last = found[id_col, take - 1].value
    return (col < F.lit(at.value)) | ((col == F.lit(at.value)) & (F.col(id_col) <= F.lit(last)))


def rank_conditions(
    df: DataFrame,
    key: str,
    id_col: str,
    sizes: Sequence[int],
    bracket_rows: int = BRACKET_ROWS,
    total: int | None = None,
) -> list[Column]:
    """For each size, a row condition that holds for exactly the first rows by (key, id).

    The rows themselves are never shuffled: a cut is a plain filter. ``total`` may
    give the number of rows with a key.
    """
    df = one_zero(df.select(key, id_col), [key])
    known = None if total is None else {key: total}
    inner = [s for s in sizes if s > 0 and (total is None or s < total)]
    found = {}
    if inner:
        found, counts = search_ranks(df, {key: [s - 1 for s in inner]}, None, known, bracket_rows)
        total = counts[key]
    conditions = []
    for s in sizes:
        if s <= 0:
            conditions.append(F.lit(False))
        elif s >= total:
            conditions.append(F.lit(True))
        else:
            conditions.append(_cut_condition(df, key, id_col, s, found[key, s - 1]))
    return conditions


def first_k(
    df: DataFrame,
    order: Column,
    k: int,
    id_col: str = ROW_ID,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """The first ``k`` rows by (order, id), never more; a missing order (null, NaN) comes last.

    Only (order, id) pairs are written, and counted while they are; the cut is searched
    in them for every ``k``, and the rows themselves are filtered where they are.
    """
    keyed = one_zero(nan_to_null(df.withColumn("_order", order)), ["_order"])
    keys, size = stage_counted(
        keyed.select("_order", id_col), "keys", rows=F.count(F.lit(1)), present=F.count("_order")
    )
    wanted = _first(keys, k, id_col, size, bracket_rows)
    return (keyed if wanted is None else keyed.where(wanted)).drop("_order")


def first_scored(scored: DataFrame, k: int, id_col: str = ROW_ID, score: str = "score") -> DataFrame:
    """The ``k`` rows of highest score, ties to the lower id, from a narrow table of scores.

    The table is written once, and both the cut and the answer are read from it: a
    costly score is computed once for each row.
    """
    kept = one_zero(nan_to_null(scored), [score])
    order = (-F.col(score)).alias("_order")
    keys, size = stage_counted(
        kept.select(*scored.columns, order), "scores", rows=F.count(F.lit(1)), present=F.count("_order")
    )
    wanted = _first(keys, k, id_col, size, BRACKET_ROWS)
    return (keys if wanted is None else keys.where(wanted)).drop("_order")


def _first(keys: DataFrame, k: int, id_col: str, size: Mapping[str, int], bracket_rows: int) -> Column | None:
    """Condition on ``_order`` and the id for the first ``k`` rows; None for all rows."""
    if k >= size["rows"]:
        return None
    present = F.col("_order").isNotNull()
    if k <= size["present"]:
        (inside,) = rank_conditions(keys, "_order", id_col, [k], bracket_rows, size["present"])
        return present & inside
    rest, rank = keys.where(~present).select(id_col), k - size["present"] - 1
    found = order_statistics(rest, {id_col: [rank]}, {id_col: size["rows"] - size["present"]}, bracket_rows)
    return present | (F.col(id_col) <= F.lit(found[id_col, rank].value))


def text_prefix(text: Column) -> Column:
    """The leading bytes of a text as a number that keeps the order of texts."""
    digits = F.rpad(F.hex(F.substring(text.cast("binary"), 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def commonest(counts: DataFrame, n: str, text: str, k: int, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Exactly the first ``k`` rows by (count descending, text); texts are distinct.

    The cut is found by rank selection on the counts, then on the leading bytes of
    the texts that share the last count, so only texts that agree in those meet in a
    sorted limit.
    """
    rows, seen = stage_counted(counts.withColumn("_prefix", text_prefix(F.col(text))), "counts", rows=F.count(F.lit(1)))
    keys = rows.select((-F.col(n)).alias("_less"), "_prefix")
    total = seen["rows"]
    if k >= total or k <= 0:
        return rows.drop("_prefix").where(F.lit(k > 0))
    at = order_statistics(keys, {"_less": [k - 1]}, {"_less": total}, bracket_rows)["_less", k - 1]
    count, rest = -at.value, k - at.below
    above = F.col(n) > F.lit(count)
    if rest == at.equal:
        return rows.where(above | (F.col(n) == F.lit(count))).drop("_prefix")
    tied = rows.where(F.col(n) == F.lit(count))
    cut = order_statistics(tied, {"_prefix": [rest - 1]}, {"_prefix": at.equal}, bracket_rows)
    cut = cut["_prefix", rest - 1]
    same = tied.where(F.col("_prefix") == F.lit(cut.value)).select(text)
    last = same.orderBy(text).limit(rest - cut.below).agg(F.max(text)).first()[0]
    wanted = above | (
        (F.col(n) == F.lit(count))
        & ((F.col("_prefix") < F.lit(cut.value))
           | ((F.col("_prefix") == F.lit(cut.value)) & (F.col(text) <= F.lit(last))))
    )
    return rows.where(wanted).drop("_prefix")
