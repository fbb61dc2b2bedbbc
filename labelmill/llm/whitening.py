"""Embedding whitening: leading components of the covariance by Jacobi-Davidson, matrix-free.

The covariance is never formed. The distinct lattice vectors are written once, in
blocks of small integers; every product with it is one Spark job that centres each
block exactly, multiplies it with a few columns and adds the partial results up. The
driver holds some columns of the vectors' dimension, whatever the number of rows:
the search space, its images, and what is locked.

Each outer step takes Ritz pairs of the search space, locks the leading ones whose
residual has reached double precision, and solves the projected correction
equations (I - QQ')(V - theta)(I - QQ')t = -r of all others by MINRES, in step, so that
an inner iteration for all of them is one product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import map_arrow, pick
from labelmill.storage import stage

COMPONENTS = 16
#: Lattice numbers are floor(SCALE c); a constant added to all of them changes no result.
SCALE = 64
#: Lattice numbers beyond this stand at it.
MOST = 1 << 40
#: Bytes of a block of centred doubles.
BLOCK_BYTES = 2_000_000
#: Columns beside the wanted ones in the first search space, steps of MINRES, outer steps.
GUARD, INNER, OUTER = 4, 10, 200
#: A residual at most this times the greatest eigenvalue is one of double precision.
PRECISION = 2e-14
#: An eigenvalue at most this times the greatest one is zero.
ZERO = 2.0**-40
_KINDS = ("<i1", "<i2", "<i4", "<i8")
_ENDS = {k: np.iinfo(k) for k in _KINDS}


def lattice(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and floor(64 c) of the usable vectors of a batch, by length of vector."""
    vectors = batch.column(column)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(usable)
    vectors = vectors.take(pa.array(at))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten()
    entries = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]):
        mine = np.flatnonzero(sizes == size)
        table = entries[starts[mine, None] + np.arange(size)]
        fine = np.isfinite(table).all(axis=1)
        yield at[mine[fine]], np.clip(np.floor(table[fine] * SCALE), -MOST, MOST).astype(np.int64)


def _codes(column: str):
    """Each usable vector as bytes: the smallest kind of integers that holds it, then the integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, table in lattice(batch, column):
                low, high = table.min(axis=1), table.max(axis=1)
                kind = np.zeros(len(table), np.int64)
                for k in _KINDS[:-1]:
                    kind += (low < _ENDS[k].min) | (high > _ENDS[k].max)
                for i in np.unique(kind):
                    tag = bytes([i])
                    codes = [tag + row.tobytes() for row in table[kind == i].astype(_KINDS[i])]
                    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary())], names=["code"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of one kind and length put together."""
    for batch in batches:
        groups: dict[tuple[int, int], list[bytes]] = {}
        for code in batch.column("code").to_pylist():
            groups.setdefault((code[0], len(code)), []).append(code[1:])
        for (kind, length), codes in groups.items():
            size = (length - 1) >> kind
            step = max(1, BLOCK_BYTES // (8 * size))
            for i in range(0, len(codes), step):
                part = codes[i : i + step]
                yield pa.RecordBatch.from_pydict({"size": [size], "kind": [kind], "rows": [len(part)], "data": [b"".join(part)]}, schema=_BLOCK)


_BLOCK = pa.schema([("size", pa.int64()), ("kind", pa.int64()), ("rows", pa.int64()), ("data", pa.binary())])


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, rows, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "rows", "data"))):
            yield np.frombuffer(data, _KINDS[kind]).reshape(rows, -1).astype(np.int64)


@dataclass
class FitList:
    """The distinct lattice vectors in blocks, their number, sums and trace of the covariance."""

    blocks: DataFrame
    size: int
    n: int
    sums: np.ndarray
    trace: float

    def total(self, work: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """Sum of ``work(centred block)``, a table of the given shape, over all blocks: one job.

        Each task adds up its blocks and gives one row; the rows are added cell by
        cell in a map-side combined aggregate, so the driver reads one table only.
        """
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((rows, columns))
            for table in _tables(batches):
                out += work(centred(table, n, sums))
            yield pa.RecordBatch.from_pydict({"cells": [out.ravel()]}, schema=pa.schema([("cells", pa.list_(pa.float64()))]))

        parts = map_arrow(self.blocks, run, "cells array<double>")
        cells = parts.select(F.posexplode("cells").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(rows * columns)
        out[cells.column("at").to_numpy()] = cells.column("v").to_numpy()
        return out.reshape(rows, columns)

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times some columns."""
        return self.total(lambda b: b.T @ (b @ columns), *columns.shape) / self.n


def deviations(table: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: int64 where it fits, else whole numbers of any size."""
    most = n * max(int(np.abs(table).max(initial=0)), 1) + max(map(abs, sums.tolist()), default=0)
    if most >= 1 << 62:
        return n * table.astype(object) - sums
    return n * table - sums.astype(np.int64)


def centred(table: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n as doubles."""
    return (deviations(table, n, sums) / n).astype(np.float64)


def fit_list(vectors: DataFrame, column: str = "embedding") -> FitList | None:
    """Each distinct usable vector once. None if there is none.

    A vector is usable if it and its entries are neither null, NaN nor infinite. All have the
    length that most distinct ones have (of equal numbers, the greater); vectors
    of another length, empty ones too, belong to no common space and are left out.
    """
    codes = map_arrow(pick(vectors, column), _codes(column), "code binary").distinct()
    blocks = stage(map_arrow(codes, _blocks, "size long, kind long, rows long, data binary"), "vectors")
    common = blocks.groupBy("size").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return None
    size = common.size
    blocks = blocks.where(F.col("size") == size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(size, object), np.zeros(size, object)
        for table in _tables(batches):
            first += table.sum(axis=0).astype(object)
            wide = table if np.abs(table).max() < 1 << 20 else table.astype(object)
            second += (wide * wide).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({"at": np.arange(size), "first": [str(x) for x in first], "second": [str(x) for x in second]},
                                         schema=pa.schema([("at", pa.int64()), ("first", pa.string()), ("second", pa.string())]))

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = map_arrow(blocks, run, "at long, first string, second string").groupBy("at").agg(exact("first"), exact("second")).collect()
    sums = np.zeros(size, object)
    spread = 0
    n = int(common.n)
    for r in rows:
        sums[r["at"]] = int(r["first"])
        spread += n * int(r["second"]) - int(r["first"]) ** 2
    return FitList(blocks, size, n, sums, spread / n**2)


def minres(product: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, q: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Columns t with (I - QQ')(V - theta_j)(I - QQ') t_j near ``right``'s column j, all in step."""
    inside = lambda y: y - q @ (q.T @ y)
    norm = lambda y: np.sqrt((y * y).sum(axis=0))
    safe = lambda a: np.where(a > 0, a, 1.0)
    y = r2 = inside(right)
    r1 = w = w2 = t = np.zeros_like(y)
    beta = first = norm(y)
    before = np.ones_like(beta)
    dbar, eps, phibar, cs, sn = 0 * beta, 0 * beta, beta, -np.ones_like(beta), 0 * beta
    for step in range(steps):
        # a column whose residual is at the bottom takes no further part
        live = (beta > 1e-15 * first) & (phibar > 1e-4 * first)
        if not live.any():
            break
        v = y / safe(beta)
        y = inside(product(v) - v * theta)
        if step:
            y = y - r1 * (beta / safe(before))
        alpha = (v * y).sum(axis=0)
        y = y - r2 * (alpha / safe(beta))
        r1, r2, before, beta = r2, y, beta, norm(y)
        old, delta, gbar, eps, dbar = eps, cs * dbar + sn * alpha, sn * dbar - cs * alpha, sn * beta, -cs * beta
        gamma = safe(np.hypot(gbar, beta))
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, sn * phibar
        w2, w = w, (v - w2 * old - w * delta) / gamma
        t = t + np.where(live, phi, 0.0) * w
    return inside(t)


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns of the span of ``new`` outside the spans of ``against``."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
    for _ in range(2):
        for q in against:
            new = new - q @ (q.T @ new)
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-7 * max(s.max(initial=0), 1e-300)] if s.size and s[0] > 1e-12 else u[:, :0]
    return new


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, their unit vectors (columns) and residual norms.

    ``product`` applies a symmetric matrix without negative eigenvalues. All pairs are
    locked in falling order once their residual is at most PRECISION times the
    greatest eigenvalue. The search space is cut to its leading half when it is full.
    """
    wanted = min(wanted, size)
    width = min(size, wanted + GUARD)
    full = min(size, 6 * width)
    locked, values, left = np.zeros((size, 0)), np.zeros(0), np.zeros(0)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    image = product(basis)
    for _ in range(OUTER):
        h = basis.T @ image
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        basis, image = basis @ s, image @ s
        need = wanted - len(values)
        top = max(theta[0], values.max(initial=0))
        rest = image[:, :need] - basis[:, :need] * theta[:need]
        rest -= locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        # images of combined columns carry their rounding along: those near the goal are taken anew
        near = np.flatnonzero((norms > PRECISION * top) & (norms < 1e3 * PRECISION * top))
        whole = basis.shape[1] + len(values) >= size
        if whole or len(near):
            near = np.arange(len(norms)) if whole else near
            image[:, near] = product(basis[:, near])
            rest[:, near] = image[:, near] - basis[:, near] * theta[near]
            rest -= locked @ (locked.T @ rest)
            norms = np.linalg.norm(rest, axis=0)
        done = norms <= PRECISION * top
        ready = int(np.argmin(done)) if not done.all() else len(done)
        locked, values = np.hstack((locked, basis[:, :ready])), np.append(values, theta[:ready])
        left = np.append(left, norms[:ready])
        basis, image, theta, rest = basis[:, ready:], image[:, ready:], theta[ready:], rest[:, ready:]
        if len(values) == wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], left[order]
        if basis.shape[1] + rest.shape[1] > full:
            basis, image = basis[:, : full // 2], image[:, : full // 2]
        need = wanted - len(values)
        open_ = np.flatnonzero(np.linalg.norm(rest[:, :need], axis=0) > PRECISION * top)
        t = minres(product, theta[:need][open_], np.hstack((locked, basis[:, :need])), -rest[:, :need][:, open_], INNER)
        more = _orthonormal(t, locked, basis)[:, : size - len(values) - basis.shape[1]]
        if more.shape[1]:
            basis, image = np.hstack((basis, more)), np.hstack((image, product(more)))
    raise ArithmeticError(f"{len(values)} of {wanted} pairs after {OUTER} steps; residuals {norms}")


@dataclass
class Whitening:
    """Components of a fit list: eigenvalues, unit vectors, residual norms, distance from identity."""

    fitted: FitList
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    identity_error: float


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Leading components; None without a usable vector or if all are equal.

    Components of an eigenvalue of zero cannot be whitened and are left out.
    """
    fitted = fit_list(vectors, column)
    if fitted is None or not fitted.trace > 0:
        return None
    values, columns, residuals = leading_pairs(fitted.product, fitted.size, components)
    some = values > ZERO * values[0]
    values, columns, residuals = values[some], columns[:, some], residuals[some]
    scaled, k = columns / np.sqrt(values), len(values)
    mean = fitted.total(lambda b: (b @ scaled).sum(axis=0, keepdims=True), 1, k) / fitted.n
    square = lambda z: z.T @ z
    spread = fitted.total(lambda b: square(b @ scaled - mean), k, k) / fitted.n
    return Whitening(fitted, values, columns, residuals, float(np.abs(spread - np.eye(k)).max()))


KINDS = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows with a null vector, a null or non-finite entry, or another length than the fit
    list's are left out; repeated rows and null keys stay. An empty table, one of
    unusable rows, or one of equal vectors gives no rows. Entries beyond 2^40 / 64 stand at
    that bound. A deviation of more than 38 digits is null. Equal eigenvalues have
    some orthonormal vectors of their space. Other columns are not read.
    """
    found = fit_whitening(vectors, column, components)
    rows = pick(vectors, key, column).withColumn(key, F.col(key).cast("long"))
    if found is None:
        return vectors.sparkSession.createDataFrame([], KINDS)
    n, sums, size, k = found.fitted.n, found.fitted.sums, found.fitted.size, len(found.values)
    scaled, explained = found.vectors / np.sqrt(found.values), found.values / found.fitted.trace
    error, kind = found.identity_error, pa.decimal128(38, 0)

    def squares(away: np.ndarray) -> pa.Array:
        if away.dtype != object and int(np.abs(away).max(initial=0)) ** 2 * away.shape[1] < 1 << 62:
            return pa.array((away * away).sum(axis=1)).cast(kind)
        exact = ((away.astype(object)) ** 2).sum(axis=1).tolist()
        return pa.array([Decimal(x) if x < 10**38 else None for x in exact], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, table in lattice(batch, column):
                if table.shape[1] != size:
                    continue
                step = max(1, BLOCK_BYTES // (8 * size))
                for i in range(0, len(at), step):
                    away = deviations(table[i : i + step], n, sums)
                    m = len(away)
                    each = pa.array(np.repeat(np.arange(m), k))
                    ids = batch.column(key).take(pa.array(at[i : i + step]))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                         squares(away).take(each), pa.array(((away / n).astype(np.float64) @ scaled).ravel()),
                         pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return map_arrow(rows, run, KINDS)
