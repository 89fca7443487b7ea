"""Nearest neighbours by vantage-point trees, one per shard, for the largest inner product.

Inner products are turned into distances by one more coordinate: a vector x
becomes (x, sqrt(M^2 - |x|^2)) / M with M the largest norm, a query q becomes
(q / |q|, 0), and then |q - x|^2 = 2 - 2 <q, x> / (|q| M). The triangle
inequality holds among the lifted vectors.

Shards are made by a hash of vec_id, each of about ``shard_rows`` vectors, and
a shard is split into bands of norms, each down to half of its own largest
norm M, with a tree of its own. So distances spread alike whatever the norms
of other vectors or of the query are. A tree splits at the median distance to
a vantage point until a leaf has ``leaf`` vectors; a node keeps the range of
distances of either side. A query takes the bands from the largest norm down,
the leaves of a band in the order of their lower bounds, and stops where
``factor * bound`` reaches the distance of its k-th best: factor 1 is exact
search, a larger one prunes more.

Queries meet every shard in blocks of bounded size: a group holds one shard
and one block of queries. Each gives at most k rows per query, and the best k over all shards remain.

Defined cases: vectors that are null, zero (or empty) or hold a null or
non-finite component take no part, nor do rows with a null vec_id; vectors of different lengths are
never compared; rows that repeat a vec_id count once each as candidates, and as a query
once; a query is never its own candidate; ties go to the smaller
vec_id; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import DOUBLE, LONG, schema


def takes_part(column: str = "embedding") -> Column:
    """Whether a row has an id and a non-zero vector of finite components."""
    v = F.col(column).cast("array<double>")
    fine = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    return F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v: array of double, dim) of the rows that take part."""
    v = F.col(column).cast("array<double>")
    return vectors.where(takes_part(column)).select("vec_id", v.alias("v"), F.size(v).alias("dim"))


class VantageTree:
    """Over lifted vectors. ``paths[leaf]``: its (vantage point, nearest, farthest) rings, root first."""

    def __init__(self, x: np.ndarray, leaf: int, seed: int = 7):
        self.x, self.points, self.leaves, self.paths = x, [], [], []
        rng = np.random.default_rng(seed)

        def build(rows: np.ndarray, path: list[tuple[int, float, float]]) -> None:
            if len(rows) <= leaf:
                self.leaves.append(rows)
                self.paths.append(path)
                return
            some = rng.choice(rows, min(8, len(rows)), replace=False)  # the one that spreads a sample most
            probe = rng.choice(rows, min(64, len(rows)), replace=False)
            spread = [np.std(np.sqrt(np.maximum(((x[probe] - x[s])**2).sum(1), 0))) for s in some]
            v = int(some[int(np.argmax(spread))])
            d = np.sqrt(((x[rows] - x[v])**2).sum(1))
            order = np.argsort(d, kind="stable")  # halves by rank, so equal distances split too
            half = len(rows) // 2
            k = len(self.points)
            self.points.append(v)
            for part in (order[:half], order[half:]):
                build(rows[part], [*path, (k, float(d[part].min()), float(d[part].max()))])

        build(np.arange(len(x)), [])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Lower bounds of the distance from each query to each leaf, by the rings on its path."""
        out = np.zeros((len(q), len(self.leaves)))
        if self.points:
            p = self.x[self.points]
            d = np.sqrt(np.maximum((q**2).sum(1)[:, None] + (p**2).sum(1)[None, :] - 2 * q @ p.T, 0))
            for i, path in enumerate(self.paths):
                for k, near, far in path:
                    np.maximum(out[:, i], np.maximum(near - d[:, k], d[:, k] - far), out=out[:, i])
        return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added from left to right, so that equal vectors give equal numbers."""
    return np.cumsum(a * b, axis=1)[:, -1]


def exact_scores(q: np.ndarray, qi: np.ndarray, x: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (qi, xi) by :func:`inner`, some rows at a time."""
    step = max(1, 2_000_000 // q.shape[1])
    return np.concatenate([np.zeros(0), *(inner(q[qi[i:i + step]], x[xi[i:i + step]]) for i in range(0, len(qi), step))])


def norms_of(a: np.ndarray) -> np.ndarray:
    """Euclidean norms of non-zero rows, without overflow or underflow of the squares."""
    most = np.abs(a).max(axis=1)
    return most * np.sqrt(((a / most[:, None])**2).sum(1))


def norm_bands(norms: np.ndarray) -> list[np.ndarray]:
    """The rows by falling norm, cut so that a band's norms are above half of its largest."""
    order = np.argsort(-norms, kind="stable")
    falling, out, at = -norms[order], [], 0
    while at < len(order):
        end = int(np.searchsorted(falling, falling[at] / 2, side="left"))
        out.append(order[at:end])
        at = end
    return out


def search_shard(x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, *, k: int, factor: float,
                 leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, inner product) of each query's k best in this shard, its own id left out."""
    norms, q_norms = norms_of(x), norms_of(q)
    lifted = np.column_stack([q / q_norms[:, None], np.zeros(len(q))])
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    kth = np.full(len(q), -np.inf)
    for band in norm_bands(norms):
        top = norms[band[0]]
        lift = np.sqrt(np.maximum(1 - (norms[band] / top)**2, 0))
        tree = VantageTree(np.column_stack([x[band] / top, lift]), leaf)
        bound = tree.bounds(lifted) * factor
        turn = np.empty_like(bound, dtype=np.int32)  # a leaf's place in the query's order of bounds
        np.put_along_axis(turn, np.argsort(bound, axis=1, kind="stable"), np.arange(bound.shape[1], dtype=np.int32)[None, :], 1)
        scale = q_norms * top
        lo, hi = 0, 2
        while lo < len(tree.leaves):
            # the next leaves in each query's order, those only whose bound is within the distance of its k-th best
            radius = np.sqrt(np.maximum(2 - 2 * kth / scale, 0) + 1e-12) + 1e-7
            due = (turn >= lo) & (turn < hi) & (bound <= radius[:, None])
            parts = [found]
            for leaf_no in np.flatnonzero(due.any(axis=0)):
                qs, rows = np.flatnonzero(due[:, leaf_no]), band[tree.leaves[leaf_no]]
                s = q[qs] @ x[rows].T
                least = kth[qs] - 1e-11 * scale[qs]  # matrix products only preselect: their rounding hangs on the leaf
                i, j = np.nonzero((s >= least[:, None]) & (q_ids[qs][:, None] != ids[rows][None, :]))
                parts.append((qs[i], rows[j], exact_scores(q, qs[i], x, rows[j])))
            if len(parts) > 1:
                qi, xi, score = (np.concatenate(c) for c in zip(*parts))
                o = np.lexsort((ids[xi], -score, qi))
                qi, xi, score = qi[o], xi[o], score[o]
                rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
                kth[qi[rank == k - 1]] = score[rank == k - 1]
                o = rank < k
                found = (qi[o], xi[o], score[o])
            lo, hi = hi, hi * 4
    return found


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, factor: float = 1.2, shard_rows: int = 8192,
           query_rows: int = 4096, leaf: int = 64) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the k nearest found for each query row of ``vectors``."""
    rows = usable(vectors)
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-n["n"] // shard_rows)), max(1, -(-n["q"] // query_rows))
    spread = lambda c, parts, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(parts)).cast("int")
    index = (rows.withColumn("shard", spread("vec_id", shards, 1))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (rows.where(is_query).dropDuplicates(["vec_id"]).withColumn("block", spread("vec_id", blocks, 2))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def run(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        x, q = x.sort_values("vec_id"), q.sort_values("vec_id")
        ids, q_ids = x["vec_id"].to_numpy(), q["vec_id"].to_numpy()
        qi, xi, score = search_shard(np.stack(x["v"].to_numpy()), ids, np.stack(q["v"].to_numpy()), q_ids, k=k,
                                     factor=factor, leaf=leaf)
        return pd.DataFrame({"query_id": q_ids[qi], "vec_id": ids[xi], "score": score})

    group = ["dim", "shard", "block"]
    own = lambda d: d.select(*[F.col(c).alias(c) for c in (*group, "vec_id", "v")]).groupBy(*group)
    found = own(index).cogroup(own(asked)).applyInPandas(run, schema(query_id=LONG, vec_id=LONG, score=DOUBLE))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
