"""Whitening of embeddings by shifted CholeskyQR over distributed rows.

The centred rows A (n x d) are orthogonalised without being held anywhere
together: a pass over the table sums the Gram matrix of the rows as they are
now, its Cholesky factor R_i turns each row into row * R_i^-1 by a triangular
solve, and the next pass starts from those rows. The first Gram matrix is
shifted by a multiple of the unit round-off, so that its factor exists however
badly the columns are conditioned; later ones are shifted only where they have
to be. Passes go on until the rows are orthonormal to working precision. The
composed factor R = R_k ... R_1 satisfies A = Q R, so the singular value
decomposition of R (d x d) gives the right singular vectors of A, the
components, and its singular values, whose squares over n are the eigenvalues.

Entries are first put on a grid, x = floor(64 c) + 1000000 as long, so sums
and deviations are exact integers, and centring subtracts S / n from integers
of equal size. Between passes only d x d sums exist on the driver; every pass
reads the saved grid rows and keeps one Gram matrix per task, which are summed
by a shuffle over their entries.

Defined cases: rows whose vector is null or holds null or non-finite entries
are dropped, and so are empty vectors and vectors whose length is not the most
common one (ties: the smaller length); zero vectors take part; rows with a null vec_id take
part and keep their null; repeated rows count each; components whose singular
value is below ``RANK_TOLERANCE`` of the largest (constant or dependent
dimensions) are not returned, so a table of equal vectors, of one row or of
none gives an empty result; other columns are ignored. A deviation beyond the range of a
long fails the job instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import DOUBLE, INT, LONG, save, schema

SCALE, OFFSET = 64, 1_000_000
RANK_TOLERANCE = 1e-10  # of the largest singular value
ORTHONORMAL = 1e-12     # largest entry of the last pass's Gram matrix minus the identity
MAX_PASSES = 8

_X = T.ArrayType(LONG)


def grid_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, x: array of long) of the rows that take part, saved."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size(v) > 0)
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    rows = save(rows, "whiten-x")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return rows.where(F.size("x") == (common["dim"] if common else 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, rows: int = 4096):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(0), _matrix(part.column(1), dim)


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension (sums of one task are longs; beyond that decimals)."""
    dim = rows.select(F.size("x").alias("dim")).first()
    if dim is None:
        return 0, []
    dim = dim["dim"]

    def run(batches):
        total, n = np.zeros(dim, np.int64), 0
        for _, x in _blocks(batches, dim):
            total += x.sum(0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total), pa.array([n] * dim, pa.int64())],
                                         ["d", "s", "n"])

    got = (rows.select("vec_id", "x").mapInArrow(run, schema(d=INT, s=LONG, n=LONG))
           .groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())
    sums = {r["d"]: int(r["s"]) for r in got}
    return int(got[0]["n"]), [sums[d] for d in range(dim)]


class Centring:
    """Rows minus their mean: exact integers n * x - S divided once by n, so no two large numbers are subtracted as doubles."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = np.array([s // n for s in sums], np.int64)               # floor of the mean
        self.rest = np.array([(s % n) / n for s in sums], np.float64)        # mean minus floor, below one

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        n, d = self.n, x - self.base
        left = np.array([s % n for s in self.sums], np.int64)
        most = int(np.abs(d).max(initial=0) + 1) * n
        if most < 2**31 and most * most * x.shape[1] < 2**63:
            y = d * n - left
            return (y * y).sum(1).tolist()
        return [sum((int(a) * n - int(b)) ** 2 for a, b in zip(row, left)) for row in d]


def gram(rows: DataFrame, centre: Centring, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after the triangular solves by all ``factors``, summed over the table."""
    from_rows = _solver(centre, factors)
    dim = len(centre.sums)

    def run(batches):
        total = np.zeros((dim, dim))
        for _, x in _blocks(batches, dim):
            q = from_rows(x)
            total += q.T @ q
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "g"])

    return _summed(rows, run, dim)


def _summed(rows: DataFrame, run, dim: int) -> np.ndarray:
    got = rows.select("vec_id", "x").mapInArrow(run, schema(i=INT, j=INT, g=DOUBLE)).groupBy("i", "j").agg(F.sum("g").alias("g"))
    out = np.zeros((dim, dim))
    for r in got.collect():  # dim * (dim + 1) / 2 numbers
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["g"]
    return out


def solve_rows(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """q * r^-1 for an upper triangular r, by forward substitution over the columns."""
    out = np.empty_like(q)
    for j in range(r.shape[0]):
        out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _solver(centre: Centring, factors: list[np.ndarray]):
    def from_rows(x: np.ndarray) -> np.ndarray:
        q = centre.rows(x)
        for r in factors:
            q = solve_rows(q, r)
        return q
    return from_rows


def cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of g + shift * I; the shift grows tenfold until the factor exists."""
    eye = np.eye(len(g))
    while True:
        try:
            return np.linalg.cholesky(g + shift * eye).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * np.trace(g))


def shifted_cholesky_qr(rows: DataFrame, centre: Centring) -> np.ndarray:
    """The composed R (d x d) of the centred rows."""
    unit, dim = np.finfo(float).eps / 2, len(centre.sums)
    factors: list[np.ndarray] = []
    r = np.eye(dim)
    g = gram(rows, centre, factors)
    if not g.any():
        return g  # no spread at all
    shift = 11 * (centre.n * dim + dim * (dim + 1)) * unit * np.linalg.norm(g, 2)
    shift = min(shift, 1e-8 * np.linalg.norm(g, 2))  # for tables so long that the bound says nothing
    for _ in range(MAX_PASSES):
        factor = cholesky(g, shift)
        factors.append(factor)
        r = factor @ r
        g = gram(rows, centre, factors)
        live = np.diag(g) > 0.5  # directions without any spread stay near zero
        if np.abs(g - np.eye(dim))[np.ix_(live, live)].max(initial=0.0) < ORTHONORMAL:
            break
        shift = 0.0
    # what the last pass left: rows^T rows = (g^1/2 r)^T (g^1/2 r), also where a shift stands for a direction without spread
    values, axes = np.linalg.eigh(g)
    return (axes * np.sqrt(np.maximum(values, 0.0))) @ axes.T @ r


def components(rows: DataFrame, centre: Centring, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(directions d x k, eigenvalues k, trace of the covariance): k <= ``most``, by falling eigenvalue."""
    r = shifted_cholesky_qr(rows, centre)
    _, sigma, vt = np.linalg.svd(r)
    values = sigma**2 / centre.n
    k = int(min(most, (sigma > RANK_TOLERANCE * sigma[0]).sum())) if sigma[0] > 0 else 0
    v = vt[:k].T
    v = v * np.where(v[np.abs(v).argmax(0), np.arange(k)] < 0, -1.0, 1.0)  # the largest entry is positive
    return v, values[:k], float(values.sum())


def whiten(vectors: DataFrame, n_components: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row and component.

    ``whitened`` is the centred row's projection on the component over the root of
    its eigenvalue; ``identity_error`` is measured on all whitened rows by a pass of its own.
    """
    out = schema(vec_id=LONG, component=INT, n=LONG, deviation=LONG, whitened=DOUBLE, explained=DOUBLE,
                 identity_error=DOUBLE)
    rows = grid_rows(vectors)
    n, sums = column_sums(rows)
    if n == 0:
        return vectors.sparkSession.createDataFrame([], out)
    centre, dim = Centring(n, sums), len(sums)
    v, values, trace = components(rows, centre, n_components)
    k = len(values)
    if k == 0:
        return vectors.sparkSession.createDataFrame([], out)
    to_white = v / np.sqrt(values)
    explained = values / trace

    def spread(batches):  # the last row and column hold the sums, for the centring of the whitened rows
        total = np.zeros((k + 1, k + 1))
        for _, x in _blocks(batches, dim):
            w = np.hstack([centre.rows(x) @ to_white, np.ones((len(x), 1))])
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "g"])

    total = _summed(rows, spread, k + 1)
    mean = total[:k, k] / n
    error = float(np.abs(total[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches):
        for ids, x in _blocks(batches, dim):
            w, m = centre.rows(x) @ to_white, len(x)
            number = np.tile(np.arange(1, k + 1, dtype=np.int32), m)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(number), pa.array(np.full(m * k, n)),
                pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(w.reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], out.names)

    return rows.select("vec_id", "x").mapInArrow(run, out)
