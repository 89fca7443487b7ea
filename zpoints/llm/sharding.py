"""Shard rows by a k-d tree over their metadata. DataFrame operations only.

Dimensions are source, lang, logarithm of the size, and doc_id, each scaled to
[0, 1] over the table. A node of k leaves is split along its widest dimension
at the distributed weighted quantile that leaves floor(k/2)/k of its bytes on
the low side, until every leaf is one shard of ``total / n_shards`` bytes.

A quantile takes two histogram passes: 4096 cells over the node's range, then
4096 sub-cells of the cell that holds it. Rows of one cell are ordered by a tie hash.
Equal texts are a group: where its bytes fit a shard, all its rows take the metadata
of its row with the least id and a hash of the text, so they lie on one side of every split. The
rows of a larger group keep their own metadata and a hash of id and text, so a
text that a third of all rows share is split like any other value. The driver holds one row per tree node (fewer than the number
of shards), never rows or values.

Defined cases: a null text has no bytes; null metadata is a value of its own;
an empty table gives an empty result; rows equal in id and text lie on one side
of every split. Columns other than doc_id, text, source and lang
are ignored; lang is optional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

CELLS = 4096
DIMS = ("d_source", "d_lang", "d_size", "d_id")


def _unit(c: Column) -> Column:
    """A hash of a value as a number in [0, 1)."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("\u0000")).cast("binary")) / F.lit(4294967296.0)


def shard_metadata(docs: DataFrame, overhead: int) -> DataFrame:
    """doc_id, size, text_crc32, text_key, the four dimensions and the tie hash; the only pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        "doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key"),
        _unit(F.col("source")).alias("d_source"), _unit(lang).alias("d_lang"),
        F.log2(F.octet_length(text) + F.lit(1.0)).alias("d_size"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)).alias("d_id"),
    ).withColumn("tie", F.crc32(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32",
                                            "size").cast("binary")) / F.lit(4294967296.0))


def _groups_together(meta: DataFrame, most: float) -> DataFrame:
    """``meta`` with the rows of equal texts at one place, where a group of them has no more than ``most`` bytes."""
    text = ["text_key", "text_crc32", "size"]
    first = F.min(F.struct("d_id", "d_source", "d_lang")).alias("first")
    groups = (meta.groupBy(*text).agg(F.count("*").alias("copies"), first)
              .where((F.col("copies") > 1) & (F.col("copies") * F.col("size") <= most)).drop("copies"))
    joined = meta.join(groups, text, "left")
    own = [F.coalesce(F.col(f"first.{d}"), F.col(d)).alias(d) for d in ("d_source", "d_lang", "d_id")]
    tie = F.when(F.col("first").isNull(), F.col("tie")).otherwise(F.pmod(F.col("text_key"), F.lit(1 << 32)) / F.lit(4294967296.0))
    return joined.select("doc_id", "size", "text_crc32", "d_size", *own, tie.alias("tie"))


def _assign(node: dict) -> Column:
    """The tree as one expression: nested comparisons down to the node's number."""
    if "dim" not in node:
        return F.lit(node["id"])
    return F.when(F.col(node["dim"]) < node["at"], _assign(node["low"])).otherwise(_assign(node["high"]))


def _quantile(rows: DataFrame, want: list[tuple[int, int, float, float, float]]) -> dict[int, tuple[float, float, float]]:
    """One histogram pass: for each (node, dim, low, width, bytes wanted below) the cell that reaches the quantile.

    Returns node -> (cell's low end, bytes below the cell in this range, bytes of the cell).
    ``want`` has one row per node, fewer than there are shards, and is broadcast.
    """
    names = ("node", "dim", "low", "width", "wanted")
    asked = rows.sparkSession.range(1).select(F.inline(F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, w)]) for w in want])))
    inside = rows.join(F.broadcast(asked), "node").withColumn(
        "cell", F.floor((F.element_at(F.array(*DIMS), F.col("dim") + 1) - F.col("low")) / F.col("width") * CELLS))
    hist = (inside.where(F.col("cell").between(0, CELLS - 1)).groupBy("node", "wanted", "cell")
            .agg(F.sum("size").alias("bytes")))
    below = F.coalesce(F.sum("bytes").over(Window.partitionBy("node").orderBy("cell")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = hist.withColumn("below", below).where(F.col("below") + F.col("bytes") >= F.col("wanted"))
    found = reached.groupBy("node").agg(F.min(F.struct("cell", "below", "bytes")).alias("x")).collect()
    asked_of = {w[0]: w for w in want}
    return {r["node"]: (asked_of[r["node"]][2] + r["x"]["cell"] * asked_of[r["node"]][3] / CELLS, r["x"]["below"],
                        r["x"]["bytes"]) for r in found}


def kd_shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16, buckets: int = 1024) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard (0 to n_shards - 1), slot (gapless from 0 in a shard).

    Shards are near equal in bytes. Slots are numbered in two steps, by hash
    bucket and inside a bucket, so no task sorts a whole shard.
    """
    meta = save(shard_metadata(docs, overhead), "shard-meta")
    lows = meta.agg(F.sum("size").alias("bytes"), *[F.min(d).alias(f"lo_{d}") for d in DIMS], *[F.max(d).alias(f"hi_{d}") for d in DIMS]).first()
    scale = lambda d: (F.floor((F.col(d) - lows[f"lo_{d}"]) / max(lows[f"hi_{d}"] - lows[f"lo_{d}"], 1e-9)
                               * (CELLS - 1)) + F.col("tie")).alias(d)
    if lows[f"lo_{DIMS[0]}"] is not None:
        meta = save(_groups_together(meta, lows["bytes"] / n_shards).select("doc_id", "size", "text_crc32", *[scale(d) for d in DIMS]),
                    "shard-placed")
    root = {"id": 0, "first": 0, "leaves": n_shards}
    fresh = 1
    open_nodes = [root] if lows[f"lo_{DIMS[0]}"] is not None else []
    while open_nodes := [x for x in open_nodes if x["leaves"] > 1]:
        ids = {x["id"]: x for x in open_nodes}
        rows = meta.select("size", *DIMS, _assign(root).alias("node"))
        stats = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[F.min(d).alias(f"lo_{d}") for d in DIMS],
            *[F.max(d).alias(f"hi_{d}") for d in DIMS]).collect()}
        want = []
        for i, x in ids.items():
            if i not in stats:  # fewer rows than shards: the node holds nothing, its shards stay empty
                continue
            r = stats[i]
            lo, width = [r[f"lo_{d}"] for d in DIMS], [r[f"hi_{d}"] - r[f"lo_{d}"] for d in DIMS]
            dim = max(range(len(DIMS)), key=width.__getitem__)
            share = r["bytes"] * (x["leaves"] // 2) / x["leaves"]
            want.append((i, dim, lo[dim], width[dim] * (1 + 1e-9) + 1e-9, float(share)))
        coarse = _quantile(rows, want) if want else {}
        finer = [(i, d, coarse[i][0], w / CELLS, float(share - coarse[i][1])) for i, d, _, w, share in want]
        fine = _quantile(rows, finer) if finer else {}
        following = []
        for i, dim, low, width, share in finer:
            x, hit = ids[i], fine.get(i)
            if hit is None:  # rounding left the wanted bytes just past the last sub-cell
                at = low + width
            else:  # the nearer edge of the sub-cell
                at = hit[0] if share - hit[1] < hit[1] + hit[2] - share else hit[0] + width / CELLS
            few = x["leaves"] // 2
            x |= {"dim": DIMS[dim], "at": float(at), "low": {"id": fresh, "first": x["first"], "leaves": few},
                  "high": {"id": fresh + 1, "first": x["first"] + few, "leaves": x["leaves"] - few}}
            fresh += 2
            following += [x["low"], x["high"]]
        open_nodes = following

    def leaf_ids(x: dict) -> None:
        x["id"] = x["first"]
        for side in ("low", "high"):
            if "dim" in x:
                leaf_ids(x[side])

    leaf_ids(root)
    out = meta.withColumn("shard", _assign(root).cast("int")).select("doc_id", "size", "text_crc32", "shard")
    out = out.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    counts = out.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return out.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + nth - 1).cast("long").alias("slot"))
