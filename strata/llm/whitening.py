"""Whitening of embeddings by eigenvectors refined in mixed precision.

Spark sums: dimension sums first, then products of vectors centred at the
rounded mean. Entries are whole numbers, so both are exact, and exact
arithmetic takes out what rounding left of the mean. What comes to the driver
is the square of the dimension, however many rows there are.

The covariance gets its eigenvectors in float32 first. Matrix products in
extended precision then correct them (Ogita and Aishima, "Iterative refinement
for symmetric eigenvalue decomposition", 2018): every step doubles the digits.
Where eigenvalues are too close for that, the vectors of a cluster span the
right space but are mixed in it; the matrix restricted to that space, with the
cluster's mean taken off its diagonal, is small and well scaled, and is solved
by itself (part II of that paper, 2019).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
STEPS = 40  # refinement steps after which a matrix is given up
BATCH = 1 << 16  # most rows multiplied at once
HIGH = np.longdouble  # 64 bits of significand on x86; a double where the platform has nothing wider


def scaled(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: ``floor(64 c) + 1000000`` of each entry, as longs, for the vectors that can be whitened.

    Vectors that are null or hold null, NaN or infinite entries are left out,
    as are those whose length is not the most frequent one (of equally
    frequent ones, the largest): they lie in no common space. Empty vectors
    have no components and are left out too. An entry too large for a long is an error.
    """
    c = F.col("v")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(c.isNotNull() & ~F.exists(c, bad))
    x = F.transform(c, lambda e: F.floor(SCALE * e) + OFFSET)
    rows = written(rows.where(F.size(c) > 0).select("vec_id", x.alias("x")), "whitening-x")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == lengths[0].d) if lengths else rows


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The last column of a batch as rows of int64."""
    lists = batch.column(batch.num_columns - 1)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def _exact_product(a: np.ndarray) -> np.ndarray:
    """``a.T @ a`` of whole numbers, without rounding, as Python integers."""
    most = max(int(a.max()), -int(a.min())) if a.size else 0
    rows = max(1, min(BATCH, (1 << 53) // max(1, most * most)))
    total = np.zeros((a.shape[1], a.shape[1]), object)
    for i in range(0, len(a), rows):
        part = a[i : i + rows]
        if most < 1 << 26:  # products of a block add up below 2 ** 53: exact in doubles
            total += (part.astype(float).T @ part.astype(float)).astype(np.int64).astype(object)
        else:
            total += part.T.astype(object) @ part.astype(object)
    return total


_CELLS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.decimal128(38, 0))])


def _cells(total: np.ndarray) -> pa.RecordBatch:
    from decimal import Decimal

    i, j = np.indices(total.shape).reshape(2, -1)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in total.ravel()], _CELLS.types[2])], schema=_CELLS)  # noqa: E501


def _summed(x: DataFrame, of) -> dict[tuple[int, int], int]:
    """The sum of ``of`` (a matrix of whole numbers per block of vectors) over all rows, by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_vectors(batch))
                total = part if total is None else total + part
        if total is not None:
            yield _cells(total)

    cells = x.select("x").mapInArrow(run, "i int, j int, value decimal(38,0)").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r.i, r.j): int(r.value) for r in cells.collect()}


class Moments:
    """``n`` vectors' sums per dimension and the exact covariance (divisor ``n``), as fractions."""

    def __init__(self, n: int, sums: list[int], centre: list[int], products: dict[tuple[int, int], int]):
        self.n, self.sums, self.centre = n, sums, centre
        self.rest = [s - n * c for s, c in zip(sums, centre, strict=True)]  # sums of the centred vectors
        d = range(len(sums))
        self.covariance = [[Fraction(n * products[i, j] - self.rest[i] * self.rest[j], n * n) for j in d] for i in d]
        self.trace = sum((self.covariance[i][i] for i in d), Fraction(0))

    def matrix(self) -> np.ndarray:
        """The covariance rounded to extended precision: the nearest double and what it leaves out."""
        high = np.array([[float(v) for v in row] for row in self.covariance])
        low = np.array([[float(v - Fraction(h)) for v, h in zip(r, hs, strict=True)] for r, hs in zip(self.covariance, high.tolist(), strict=True)])
        return high.astype(HIGH) + low.astype(HIGH)


def moments(x: DataFrame) -> Moments | None:
    """Sums, then products centred at the rounded mean, of ``x``; None if it has no rows."""
    sums = _summed(x, lambda a: np.vstack([a.astype(object).sum(axis=0), [len(a)] * a.shape[1]]))
    if not sums:
        return None
    d, n = len(sums) // 2, sums[1, 0]
    totals = [sums[0, j] for j in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    shift = np.array(centre, np.int64)
    return Moments(n, totals, centre, _summed(x, lambda a: _exact_product(a - shift)))


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    Eigenvalues that are equal to working precision have any orthonormal basis
    of their space.
    """
    a = _symmetric(a.astype(HIGH))
    scale = np.abs(a).max() if a.size else HIGH(0)
    if not scale > 0:
        return np.zeros(len(a), HIGH), np.eye(len(a), dtype=HIGH)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    eps, one = np.finfo(HIGH).eps, np.eye(len(a), dtype=HIGH)
    norm, floor = np.linalg.norm(a.astype(float)), 8 * len(a) * float(eps)
    last = math.inf
    for _ in range(STEPS):
        r = one - x.T @ x
        s = _symmetric(x.T @ a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        reach = 2 * (np.linalg.norm(off.astype(float)) + norm * np.linalg.norm(r.astype(float)))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= reach
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        for cluster in _clusters(values, reach):
            x[:, cluster] = x[:, cluster] @ _sub_solve(a, x[:, cluster])
        size = float(np.abs(np.where(near & ~np.eye(len(a), dtype=bool), 0, e)).max())
        if size <= floor or (size < 1e-14 and size >= last):
            break
        last = size
    x = x + x @ ((one - x.T @ x) / 2)
    values = np.diag(_symmetric(x.T @ a @ x))
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _clusters(values: np.ndarray, reach: float) -> list[np.ndarray]:
    """Columns of eigenvalues that lie within ``reach`` of their neighbours."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > reach) + 1
    return [c for c in np.split(order, breaks) if len(c) > 1]


def _sub_solve(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The rotation of a cluster's vectors that makes the matrix diagonal in their space."""
    inside = _symmetric(x.T @ a @ x)
    mean = np.trace(inside) / np.trace(x.T @ x)
    inside = inside - mean * (x.T @ x)
    return np.linalg.eigh((inside / max(np.abs(inside).max(), np.finfo(HIGH).tiny)).astype(float))[1].astype(HIGH)


class Whitening:
    """What a task needs to whiten vectors: centres, projections and shares of the variance."""

    def __init__(self, found: Moments, components: int = COMPONENTS):
        values, vectors = eigenvectors(found.matrix())
        trace = HIGH(float(found.trace))
        # A component without variance cannot be scaled to unit variance.
        k = int(np.sum(values[:components] > len(values) * np.finfo(float).eps * trace))
        self.n, self.centre, self.rest = found.n, np.array(found.centre, np.int64), found.rest
        self.values, self.vectors = values[:k], vectors[:, :k]
        self.explained = (self.values / trace).astype(float) if k else np.zeros(0)
        self.project = (self.vectors / np.sqrt(self.values)).astype(float)
        self.mean = np.array([float(Fraction(r, found.n)) for r in found.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(float) - self.mean) @ self.project

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per vector the sum over dimensions of ``(n x - S) ** 2``, exact; an error where that is too large for a long."""
        z = x - self.centre
        most = max(int(z.max()), -int(z.min()))
        if x.shape[1] * (self.n * most + max(map(abs, self.rest))) ** 2 < 1 << 63:
            return (np.square(self.n * z - np.array(self.rest, np.int64)).sum(axis=1)).tolist()
        found = [int(v) for v in np.square(self.n * z.astype(object) - np.array(self.rest, object)).sum(axis=1)]
        if max(found) >= 1 << 63:
            raise OverflowError("a deviation does not fit a long")
        return found


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors minus the identity, from all rows.

    Each task centres its block at the block's mean; blocks are joined by their means.
    """
    k = len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_vectors(batch))
                mean = w.mean(axis=0)
                product = (w - mean).T @ (w - mean)
                cells = np.vstack([product + len(w) * np.outer(mean, mean), len(w) * mean[None, :]])
                i, j = np.indices(cells.shape).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(cells.ravel())], names=["i", "j", "value"])

    cells = x.select("x").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = np.zeros((k + 1, k))
    for r in cells:
        found[r.i, r.j] = r.value / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max(initial=0))


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component, numbered from 1 by falling variance.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``;
    see :func:`scaled` for the vectors that are left out. Components without
    variance are left out too (none are left for a single vector or equal
    ones). Repeated rows are vectors each. Other columns are not read.
    """
    ddl = (
        f"vec_id {embeddings.schema[key].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    x = scaled(embeddings, key, vector)
    found = moments(x)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], ddl)
    model = Whitening(found, components)
    error, k = identity_error(x, model), len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m and k:
                vectors = _vectors(batch)
                keys = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                columns = [
                    keys, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(np.repeat(np.array(model.deviations(vectors), np.int64), k)), pa.array(model.whitened(vectors).ravel()),
                    pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ddl.split(", ")])

    return x.mapInArrow(run, ddl)
