"""Whitening of embeddings by shifted CholeskyQR (operator 12).

Each entry becomes a whole number; the rows' count and per-dimension sums are
exact, so a row is centred as (n * x - S) / n with one rounding.  The centred
rows are never stored.  A Gram pass sums A'A over all partitions, its Cholesky
factor (of a slightly shifted matrix in the first pass, so that it exists for
any data) turns the rows into better conditioned ones by a triangular solve
inside the tasks, and the next pass sums the Gram matrix of those.  Passes go
on until that matrix is the identity to rounding.  The product R of all factors
then has A = QR with orthonormal Q: the singular values and right vectors of R
are those of the centred table, which gives the components, their eigenvalues
(squares over n) and the whitened coordinates without ever forming a
covariance's eigenproblem.

Tasks hold one batch of rows and one matrix of dimension by dimension, and that
is all that is exchanged per partition; the driver holds single matrices.

Defined results: rows whose vector is null or empty, holds null or non-finite
entries or entries beyond 2**52, or has another length than most (ties: the
longer) take no part; null and repeated ids stay rows; every row gets as many
components as have an eigenvalue above ``RANK`` of the largest, at most ``k``,
so equal rows only give an empty result, as an empty table does; a component's
entry of largest magnitude is positive; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import durable_table, ship

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
RANK = 1e-12
ROUNDING = float(np.finfo(np.float64).eps)
PASSES = 8
LARGEST = 2.0**52


class Centre(NamedTuple):
    """Count and sums of the rows, whole numbers."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where they fit, else Python's integers."""
        most = max([abs(s) for s in self.sums], default=0) + self.n * int(max(abs(int(x.max())), abs(int(x.min()))))
        if most >= 1 << 62:
            x = x.astype(object)
        return self.n * x - np.array(self.sums, dtype=x.dtype)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


class Fit(NamedTuple):
    centre: Centre
    components: np.ndarray  # one per column
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"))
            part = x.astype(object).sum(axis=0) if max(abs(int(x.max())), abs(int(x.min()))) * len(x) >= 1 << 62 else x.sum(axis=0)
            total = [int(v) for v in part] if total is None else [a + int(b) for a, b in zip(total, part)]
            n += batch.num_rows
    if n:
        values = pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values, pa.array([n] * len(total), pa.int64())], ["i", "value", "n"])


def centre(table: DataFrame) -> Centre | None:
    rows = table.select("x").mapInArrow(_sums, "i int, value decimal(38,0), n long")
    got = sorted(rows.groupBy("i").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).collect())  # one row per dimension
    return Centre(got[0].n, tuple(int(r.value) for r in got)) if got else None


def gram(table: DataFrame, d: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of z'z over all rows z, of width d, that ``rows_of`` makes of a batch."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = rows_of(_matrix(batch.column("x")))
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            values = [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(values, ["i", "row"])

    parts = table.select("x").mapInArrow(partial, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    out = np.zeros((d, d))
    for r in cells.collect():  # the cells of one matrix
        out[r.i, r.j] = r.value
    return (out + out.T) / 2


def solve(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """The rows times the inverse of each upper triangular factor in turn, by
    forward substitution over the columns."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def cholesky(matrix: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of the matrix, with the shift and ten times more each time
    while it does not exist."""
    d = len(matrix)
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, ROUNDING * max(float(np.trace(matrix)), np.finfo(np.float64).tiny / ROUNDING))


def triangular_factor(table: DataFrame, at: Centre, first: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """R of the centred rows, whose Gram matrix is ``first``, composed of one
    factor per pass."""
    d = len(at.sums)
    factors: list[np.ndarray] = []
    composed = np.eye(d)
    for turn in range(passes):
        done = tuple(factors)
        g = gram(table, d, lambda x: solve(at.rows(x), list(done))) if turn else first
        if turn and np.abs(g - np.eye(d)).max() < 100 * d * ROUNDING:
            break
        # the shift that lets the first factor exist whatever the condition
        shift = 11 * (at.n * d + d * (d + 1)) * ROUNDING / 2 * float(np.linalg.norm(g, 2)) if turn == 0 else 0.0
        r = cholesky(g, min(shift, float(np.linalg.norm(g, 2)) / 100))
        factors.append(r)
        composed = r @ composed
    return composed


def fit(table: DataFrame, k: int = COMPONENTS) -> Fit | None:
    at = centre(table)
    if at is None:
        return None
    d = len(at.sums)
    first = gram(table, d, at.rows)
    if not first.any():
        return None
    _, sigma, right = np.linalg.svd(triangular_factor(table, at, first))
    kept = [i for i in range(min(k, d)) if sigma[i] ** 2 > RANK * sigma[0] ** 2]
    parts = right[kept].T
    parts = parts * np.where(parts[np.abs(parts).argmax(axis=0), range(len(kept))] < 0, -1.0, 1.0)
    e = sigma[kept] ** 2 / at.n
    onto = parts / np.sqrt(e)
    # the whitened rows' own covariance, centred before multiplying
    ones = gram(table, len(kept) + 1, lambda x: np.hstack([at.rows(x) @ onto, np.ones((len(x), 1))]))
    mean = ones[-1, :-1] / at.n
    cov = gram(table, len(kept), lambda x: at.rows(x) @ onto - mean) / at.n
    return Fit(at, parts, e, float((sigma**2).sum() / at.n), float(np.abs(cov - np.eye(len(kept))).max()))


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.col("embedding")
    table = embeddings.where(usable(vector)).select("vec_id", whole(vector).alias("x"))
    table = durable_table(table)
    lengths = table.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.agg(F.max_by("d", F.struct("rows", "d"))).first()[0]
    table = table.where(F.size("x") == F.lit(usual))
    fitted = None if usual is None else fit(table, k)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return spark.createDataFrame([], schema)
    at, c = fitted.centre, len(fitted.eigenvalues)
    onto = fitted.components / np.sqrt(fitted.eigenvalues)
    explained = fitted.eigenvalues / fitted.trace
    error, most = fitted.identity_error, (1 << 63) - 1

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            dev = at.deviations(x)
            if dev.dtype != object and int(np.abs(dev).max()) ** 2 * dev.shape[1] > most:
                dev = dev.astype(object)
            square = [int(v) if v <= most else None for v in (dev * dev).sum(axis=1)]
            white = at.rows(x) @ onto
            m = batch.num_rows
            which = pa.array(np.repeat(np.arange(m), c))
            columns = [
                batch.column("vec_id").take(which), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, at.n)),
                pa.array(square, pa.int64()).take(which), pa.array(white.reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * c, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.mapInArrow(project, schema)
