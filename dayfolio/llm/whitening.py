"""Whitening of embeddings by a polarisation covariance.

Only variances are aggregated: of every dimension and of every sum of two
dimensions. Half of what the variance of a sum has beyond those of its two
parts is their covariance. All sums are of integers and exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfolio.llm.common import staged, unstage

#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: From here on an entry does not fit a long; its row is dropped like one with an infinite entry.
LIMIT = 2.0**56
_LONG = 2**63


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: n distinct vectors, their sums, unit components as columns, variances and shares of the whole."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def base(self) -> np.ndarray:
        """The mean of each dimension, rounded down."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the mean has beyond the base."""
        return [s % self.n for s in self.sums]

    def project(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.base).astype(float) - np.array([r / self.n for r in self.rest])
        return centred @ (self.components / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sum) squared; None beyond 64 bits."""
        z, rest = x - self.base, self.rest
        if len(rest) * (self.n * (int(np.abs(z).max(initial=0)) + 1)) ** 2 >= _LONG:
            z = z.astype(object)
        return [d if d < _LONG else None for d in ((z * self.n - np.array(rest, z.dtype)) ** 2).sum(axis=1).tolist()]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, x) of the rows that can be used, and their dimension.

    A row is left out if its vector is null, empty, holds a null, NaN, infinite
    or far too large entry, or has another length than most (of equally
    frequent lengths the largest counts).
    """
    usable = F.forall("_v", lambda c: c.isNotNull() & (F.abs(c) < LIMIT)) & (F.size("_v") > 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("_v")).filter(F.col("_v").isNotNull() & usable)
    lengths = rows.groupBy(F.size("_v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size"))
    most = lengths.first()
    width = most["size"] if most else 0
    return rows.filter(F.size("_v") == width).select("id", F.transform("_v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x")), width


def _exact_totals(fit: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, list[int]]:
    """Sums over all vectors of the integer rows that ``of`` makes of a batch, by row number.

    A task sends one entry per row number, whatever its number of vectors;
    entries meet by row number and come to the driver as width times a row.
    """
    schema = "key int, sums array<string>"

    def packed(keys: list[int], sums: list[list[int]]) -> list[pa.Array]:
        return [pa.array(keys, pa.int32()), pa.array([[str(v) for v in row] for row in sums], pa.list_(pa.string()))]

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch.column(0), width)).astype(object)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(packed(list(range(len(total))), total.tolist()), names=["key", "sums"])

    def merge(parts: pa.Table) -> pa.Table:
        rows = ([int(v) for v in row] for row in parts.column("sums").to_pylist())
        return pa.Table.from_arrays(packed([parts.column("key")[0].as_py()], [[sum(c) for c in zip(*rows, strict=True)]]), names=["key", "sums"])

    merged = fit.select("x").mapInArrow(in_task, schema).groupBy("key").applyInArrow(merge, schema)
    return {r["key"]: [int(v) for v in r["sums"]] for r in merged.collect()}


def covariance(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, covariance with divisor n) of integer vectors, by polarisation.

    Values are centred by the mean rounded down, which is an integer, so their
    squares add up exactly; what the mean has beyond it is taken off exactly at
    the end. Dimension i is paired with those that follow it, in a ring, up to
    half way round: every pair once or twice, and as many for each i.
    """
    def sums(x: np.ndarray) -> np.ndarray:
        if len(x) * int(np.abs(x).max(initial=0)) >= _LONG:
            x = x.astype(object)
        return np.append(x.sum(axis=0), len(x))[:, None]

    found = _exact_totals(fit, width, sums)
    if not found:
        return 0, [0] * width, np.zeros((width, width))
    total, n = [found[i][0] for i in range(width)], found[width][0]
    base, rest = np.array([s // n for s in total], np.int64), [s % n for s in total]

    def squares(x: np.ndarray) -> np.ndarray:
        z = x - base
        if len(z) * (2 * int(np.abs(z).max(initial=0))) ** 2 >= _LONG:
            z = z.astype(object)
        pairs = [((z + np.roll(z, -k, axis=1)) ** 2).sum(axis=0) for k in range(1, width // 2 + 1)]
        return np.stack([(z * z).sum(axis=0), *pairs], axis=1)

    found = _exact_totals(fit, width, squares)
    own = [n * found[i][0] - rest[i] ** 2 for i in range(width)]  # n * n times the variance
    matrix = np.zeros((width, width))
    for i in range(width):
        matrix[i, i] = own[i] / n**2
        for k in range(1, width // 2 + 1):
            j = (i + k) % width
            both = n * found[i][k] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return n, total, matrix


def fit_whitening(fit: DataFrame, width: int, most: int = 16) -> Whitening:
    """The ``most`` strongest components of distinct vectors x.

    Components go by falling variance; the largest entry of each is positive.
    One without variance beyond rounding cannot be scaled and is left out, so
    there are fewer than ``most`` if the vectors span less. The covariance, a
    matrix whose size is the dimension squared, is all that the driver holds.
    """
    n, sums, matrix = covariance(fit, width)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > max(values.max(initial=0.0), 0.0) * width * np.finfo(float).eps][:most]
    parts = vectors[:, order]
    parts = parts * np.where(np.take_along_axis(parts, np.abs(parts).argmax(axis=0)[None, :], 0) < 0, -1.0, 1.0) if len(order) else parts
    return Whitening(n, tuple(sums), parts, values[order], values[order] / (np.trace(matrix) or 1.0))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over all of ``fit``."""
    width, k = len(model.sums), len(model.variances)

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            y = model.project(_matrix(batch.column(0), width))
            total += np.vstack([y.T @ y, y.sum(axis=0)])
        rows, columns = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel(), t) for a, t in ((rows, pa.int32()), (columns, pa.int32()), (total, pa.float64()))], names=["i", "j", "v"])

    parts = fit.select("x").mapInArrow(in_task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((k + 1, k))
    for r in parts.collect():  # (k + 1) * k numbers
        total[r["i"], r["j"]] = r["v"] / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """(id, component, n, deviation, whitened, explained) of each row (id, x), a row per component."""
    width, k = len(model.sums), len(model.variances)
    names = [id_col, "component", "n", "deviation", "whitened", "explained"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), width)
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rows), model.n)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)), pa.array(model.project(x).ravel()), pa.array(np.tile(model.explained, len(x)))], names=names)

    return rows.select("id", "x").mapInArrow(project, f"{id_col} long, component int, n long, deviation long, whitened double, explained double")


def whiten_embeddings(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened components of all usable vectors, fitted on each distinct one once.

    1. Entries become integers and vectors with the same integers one row, so
       a vector that a third of all rows have weighs as much as any other.
    2. Exact sums, then exact sums of squares, of tasks meet by dimension.
    3. The driver takes the eigenvectors of one small matrix.
    4. The fit list's whitened covariance is measured, and all rows projected.

    Returns id, component, n, deviation, whitened, explained, identity_error:
    up to ``most`` rows per usable row, fewer if the vectors span fewer
    dimensions, none if they are all the same. Rows without a usable vector are
    dropped (see ``quantised``); repeated rows and null ids are rows like any
    other; deviation is null where it exceeds 64 bits. An empty table gives an
    empty result; other columns are ignored.
    """
    rows, width = quantised(vectors, id_col, vector_col)
    fit, folder = staged(rows.select("x").distinct())
    model = fit_whitening(fit, width, most)
    error = identity_error(fit, model)
    unstage(vectors.sparkSession, folder)
    return whiten(rows, model, id_col).withColumn("identity_error", F.lit(error))
