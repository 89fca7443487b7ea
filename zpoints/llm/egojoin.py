"""Embedding near-duplicates by the epsilon grid order join.

Cosine >= c between two vectors is distance <= eps = sqrt(2 - 2c) between
their directions. Directions are projected on their leading principal
dimensions (a projection never lengthens a distance), put in the order of their grid
cells of side eps, and cut into blocks, each with the box of its projections. The length of what
the projection leaves out is one more coordinate of the box, as two directions
are at least as far apart as these lengths differ.
The sequence is joined with itself by recursion: a pair of intervals whose
boxes are farther apart than eps is skipped with all that is in it, any other
is split. Spark carries the recursion as a table of interval pairs, level by
level, down to intervals of ``interval_bytes`` of vectors; a pair of those is one
group, and its blocks are compared in the same way inside it. A vector is sent
to as many groups as its interval has pairs left: where the directions spread
evenly over many dimensions, as in the given tables, projections are near one another and
that is nearly all, n^2 / interval vectors, and the work is saved inside the
groups: by Cauchy's inequality the cosine is at most the product of the
projections on ``screen`` axes plus the product of the lengths left out, and only rows and
columns of a block pair where this reaches the bound are multiplied whole.
:func:`pair_shares` reports the share of pairs kept on every level.

Equal vectors are one class with a count, so copies never meet as pairs. A
group returns link counts per class and a spanning forest of its links, never
the links themselves, and components are found from the forests.

Defined cases: vectors that are null, zero (or empty) or hold a null or
non-finite component link with nothing and are kept; vectors of different
lengths do not link; a row with a null vec_id links with nothing and has a
null component; rows that repeat a vec_id are one node of the components,
each row counted as a vector; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, DOUBLE, INT, LONG, components, save, schema
from .vptree import takes_part, usable

_BOX = T.ArrayType(DOUBLE)


def _unit(v: np.ndarray) -> np.ndarray:
    """Directions; scaled by the largest component first, so that no square over- or underflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v**2).sum(1, keepdims=True))


def _stack(column: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def principal_axes(classes: DataFrame, dim: int, axes: int) -> np.ndarray:
    """The ``axes`` leading principal axes (dim x axes) of the directions, from the sums of their outer products and their mean."""
    def run(batches):
        total = np.zeros((dim + 1, dim + 1))
        for pdf in batches:
            u = _unit(_stack(pdf["v"], dim))
            u = np.hstack([u, np.ones((len(u), 1))])
            total += u.T @ u
        i, j = np.triu_indices(dim + 1)
        yield pd.DataFrame({"i": i, "j": j, "x": total[i, j]}).astype({"i": "int32", "j": "int32"})

    got = classes.select("v").mapInPandas(run, schema(i=INT, j=INT, x=DOUBLE)).groupBy("i", "j").agg(F.sum("x").alias("x"))
    m = np.zeros((dim + 1, dim + 1))
    for r in got.collect():  # (dim + 1) * (dim + 2) / 2 numbers
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["x"]
    mean = m[:dim, dim] / max(m[dim, dim], 1.0)
    return np.linalg.eigh(m[:dim, :dim] / max(m[dim, dim], 1.0) - np.outer(mean, mean))[1][:, ::-1][:, :axes]


def projected(u: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates of directions on the axes, and the length of the rest as the last column."""
    p = u @ axes
    return np.column_stack([p, np.sqrt(np.maximum(1 - (p * p).sum(1), 0.0))])


def ego_blocks(classes: DataFrame, dim: int, axes: np.ndarray, eps: float, block: int, partitions: int) -> DataFrame:
    """(part, nth, ids, counts, dims, vectors, lo, hi): blocks of the sequence in epsilon grid order."""
    m = axes.shape[1]
    names = [f"c{i}" for i in range(m)]

    def cells(batches):
        for pdf in batches:
            p = np.floor(_unit(_stack(pdf["v"], dim)) @ axes / eps).astype(np.int32)
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(p, columns=names)], axis=1)

    def cut(batches):
        rest, nth, part = None, 0, None
        for pdf in batches:
            part = int(pdf["part"].iloc[0]) if len(pdf) else part
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            while len(rest) >= block:
                yield pack(rest.iloc[:block], part, nth)
                rest, nth = rest.iloc[block:], nth + 1
        if rest is not None and len(rest):
            yield pack(rest, part, nth)

    def pack(pdf, part, nth):
        v = _stack(pdf["v"], dim)
        p = projected(_unit(v), axes)
        return pd.DataFrame({
            "part": [part], "nth": [nth], "ids": [pdf["rep"].to_numpy(np.int64).tobytes()],
            "counts": [pdf["n"].to_numpy(np.int64).tobytes()], "dims": [pdf["dim"].to_numpy(np.int32).tobytes()],
            "vectors": [v.tobytes()], "lo": [p.min(0).tolist()], "hi": [p.max(0).tolist()]}).astype(
                {"part": "int32", "nth": "int32"})

    celled = classes.mapInPandas(cells, T.StructType([*classes.schema.fields, *[T.StructField(c, INT) for c in names]]))
    ordered = (celled.repartitionByRange(partitions, *names, "rep").sortWithinPartitions(*names, "rep")
               .withColumn("part", F.spark_partition_id()).select("rep", "n", "dim", "v", "part"))
    return ordered.mapInPandas(cut, schema(part=INT, nth=INT, ids=BINARY, counts=BINARY, dims=BINARY, vectors=BINARY,
                                           lo=_BOX, hi=_BOX))


def _apart(lo_a, hi_a, lo_b, hi_b):
    """Squared distance of two boxes, as a column."""
    gap = F.zip_with(F.zip_with(lo_b, hi_a, lambda x, y: x - y), F.zip_with(lo_a, hi_b, lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)


def interval_pairs(boxes: DataFrame, n: int, fan: int, eps: float, axes: int) -> DataFrame:
    """(a, b) with a <= b: the pairs of intervals within eps, by recursion from the whole sequence.

    ``boxes``: (id from 0 to n - 1, lo, hi of ``axes`` coordinates). On every level an interval is ``fan`` of the level below.
    """
    return _levels_of_pairs(boxes, n, fan, eps, axes)[-1]


def pair_shares(boxes: DataFrame, n: int, fan: int, eps: float, axes: int) -> list[float]:
    """Kept pairs as a share of all pairs of intervals, for every level from the whole sequence down to ``boxes``."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // fan))
    return [pairs.count() / (k * (k + 1) / 2) for pairs, k in zip(_levels_of_pairs(boxes, n, fan, eps, axes), reversed(sizes))]


def _levels_of_pairs(boxes: DataFrame, n: int, fan: int, eps: float, axes: int) -> list[DataFrame]:
    levels, size = [boxes], n
    while size > 1:
        up = levels[-1].groupBy(F.floor(F.col("id") / fan).alias("id")).agg(
            F.array(*[F.min(F.col("lo")[i]) for i in range(axes)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[i]) for i in range(axes)]).alias("hi"))
        levels.append(up)
        size = -(-size // fan)
    pairs = boxes.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    found = [pairs]
    for level in reversed(levels[:-1]):
        child = F.sequence(F.lit(0), F.lit(fan - 1))
        pairs = (pairs.withColumn("i", F.explode(child)).withColumn("j", F.explode(child))
                 .select((F.col("a") * fan + F.col("i")).alias("a"), (F.col("b") * fan + F.col("j")).alias("b"))
                 .where("a <= b"))
        one = level.select(F.col("id").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
        two = level.select(F.col("id").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        pairs = (pairs.join(one, "a").join(two, "b")
                 .where(_apart(F.col("la"), F.col("ha"), F.col("lb"), F.col("hb")) <= eps * eps).select("a", "b"))
        found.append(pairs)
    return found


def _join_group(dim: int, eps: float, least: float, screen: np.ndarray):
    """One pair of intervals: (node, links, root) per class that has links here."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = int(pdf["a"].iloc[0]), int(pdf["b"].iloc[0])
        pdf = pdf.sort_values("at")
        raw = [np.frombuffer(x, np.float64).reshape(-1, dim) for x in pdf["vectors"]]
        unit = [_unit(x) for x in raw]
        head = [projected(u, screen) for u in unit]
        ids = [np.frombuffer(x, np.int64) for x in pdf["ids"]]
        counts = [np.frombuffer(x, np.int64) for x in pdf["counts"]]
        dims = [np.frombuffer(x, np.int32) for x in pdf["dims"]]
        lo, hi = np.array(pdf["lo"].tolist()), np.array(pdf["hi"].tolist())
        side = pdf["interval"].to_numpy()
        first = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        links = np.zeros(first[-1], np.int64)
        parent = list(range(first[-1]))

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x in np.flatnonzero(side == a):
            gap = np.maximum(0, np.maximum(lo - hi[x], lo[x] - hi))
            near = (gap**2).sum(1) <= eps * eps
            for y in np.flatnonzero(near & (side == b)):
                if a == b and y < x:
                    continue
                most = head[x] @ head[y].T >= least - 1e-9  # what the cosine can be at most
                rows, cols = np.flatnonzero(most.any(1)), np.flatnonzero(most.any(0))
                if not len(rows):
                    continue
                cos = np.full((len(raw[x]), len(raw[y])), -2.0)
                cos[np.ix_(rows, cols)] = unit[x][rows] @ unit[y][cols].T
                linked = cos >= least
                close = np.argwhere(np.abs(cos - least) < 1e-9)
                for i, j in close:  # decided by the plain formula
                    p, q = raw[x][i], raw[y][j]
                    linked[i, j] = p.dot(q) / (np.sqrt(p.dot(p)) * np.sqrt(q.dot(q))) >= least
                linked &= dims[x][:, None] == dims[y][None, :]
                if x == y:
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                links[first[x]:first[x + 1]] += linked @ counts[y]
                if x != y:
                    links[first[y]:first[y + 1]] += linked.T @ counts[x]
                # a spanning forest of this block pair: labels sink to the least label linked
                lx, ly = np.arange(len(raw[x])), len(raw[x]) + np.arange(len(raw[y]))
                some_x, some_y = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
                sub = linked[np.ix_(some_x, some_y)]
                tx, ty = lx[some_x], ly[some_y]
                big = len(lx) + len(ly)
                while True:
                    ny = np.minimum(ty, np.where(sub, tx[:, None], big).min(0))
                    nx = np.minimum(tx, np.where(sub, ny[None, :], big).min(1))
                    if (nx == tx).all() and (ny == ty).all():
                        break
                    tx, ty = nx, ny
                at = lambda k: first[x] + k if k < len(lx) else first[y] + k - len(lx)  # noqa: E731, B023
                for k, root in [*zip(some_x, tx), *zip(len(lx) + some_y, ty)]:
                    p, q = find(at(int(k))), find(at(int(root)))
                    if p != q:
                        parent[max(p, q)] = min(p, q)
        every = np.concatenate(ids)
        live = np.flatnonzero(links)
        return pd.DataFrame({"node": every[live], "links": links[live],
                             "root": every[[find(int(k)) for k in live]] if len(live) else every[:0]})
    return run


def cosine_links(vectors: DataFrame, *, least: float = 0.9, axes: int = 8, screen: int = 24, block: int = 256,
                 interval_bytes: int = 8 << 20, fan: int = 8) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    eps = float(np.sqrt(2 - 2 * least)) + 1e-6
    rows = usable(vectors)
    classes = save(rows.groupBy("v", "dim").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
                   .select("rep", "n", "dim", "v"), "ego-classes")
    size = classes.agg(F.count("*").alias("n"), F.max("dim").alias("d")).first()
    dim, n = size["d"] or 1, size["n"]
    axes = min(axes, dim)
    leading = principal_axes(classes, dim, min(max(axes, screen), dim))
    interval = max(block, interval_bytes // (8 * dim))
    blocks = save(ego_blocks(classes, dim, leading[:, :axes], eps, block, max(1, -(-n // 4096))), "ego-blocks")
    sides = axes + 1  # coordinates of a box

    # blocks are numbered along the sequence: blocks of earlier partitions, then the place in the partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.groupBy("part").agg(F.count("*").alias("k"))
              .select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start")))
    per = max(1, interval // block)
    numbered = blocks.join(starts, "part").withColumn("at", F.col("start") + F.col("nth"))
    numbered = numbered.withColumn("interval", F.floor(F.col("at") / per))
    boxes = numbered.groupBy(F.col("interval").alias("id")).agg(
        F.array(*[F.min(F.col("lo")[i]) for i in range(sides)]).alias("lo"),
        F.array(*[F.max(F.col("hi")[i]) for i in range(sides)]).alias("hi"))
    boxes = save(boxes, "ego-boxes")
    count = boxes.agg(F.coalesce(F.max("id") + 1, F.lit(1)).alias("n")).first()["n"]
    pairs = interval_pairs(boxes, int(count), fan, eps, sides)
    placed = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("interval"))
    groups = placed.join(numbered.drop("part", "nth", "start"), "interval")
    found = save(groups.groupBy("a", "b").applyInPandas(_join_group(dim, eps, least, leading),
                                                        schema(node=LONG, links=LONG, root=LONG)), "ego-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "ego")
    classed = classes.join(links, classes["rep"] == links["node"], "left").drop("node")
    classed = classed.join(comp, classes["rep"] == comp["node"], "left").select(
        "v", "dim", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    linked = rows.join(classed, ["v", "dim"]).select("vec_id", "n_links", "component_id")
    alone = vectors.where(~takes_part()).select(F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
