"""Blocks: points gathered per octree block, and per-code statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zpoints.operators.bounded import DEFAULT_MAX_PER_ROW, collect_bounded

POINT_FIELDS = ["intensity", "classification", "red", "green", "blue"]


def point_struct():
    """A coded point as stored in a block; mortonCode first so that sorting
    the array orders points by code, then by every other field."""
    return F.struct(
        F.col("mortonCode"),
        F.struct("x", "y", "z").alias("coordinates"),
        *[F.col(c) for c in POINT_FIELDS],
    )


def collect_blocks(coded: DataFrame, max_points_per_row: int = DEFAULT_MAX_PER_ROW) -> DataFrame:
    """Coded points -> blocks (blockMortonCode, part, points[]).

    Points inside a block are sorted by mortonCode (then all fields). A
    block with more than ``max_points_per_row`` points is split over several
    rows (parts) instead of forming one unbounded row. Blocks are not
    globally sorted here: ordering is a storage concern (``write_blocks``
    range-partitions by code), and a sort before grouping would add a
    shuffle.
    """
    return collect_bounded(coded, ["blockMortonCode"], point_struct(), "points",
                           max_per_row=max_points_per_row)


def unnest_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks -> flat coded points (one row per stored point)."""
    return (blocks.select("blockMortonCode", F.inline("points"))
                  .select("coordinates.x", "coordinates.y", "coordinates.z",
                          "mortonCode", "blockMortonCode", *POINT_FIELDS))


def codes_per_block(coded: DataFrame, max_per_row: int = DEFAULT_MAX_PER_ROW) -> DataFrame:
    """blockMortonCode, part, mortonCodes[] (duplicates kept, sorted)."""
    return collect_bounded(coded, ["blockMortonCode"], F.col("mortonCode"), "mortonCodes",
                           max_per_row=max_per_row)


def block_occupancy(coded: DataFrame) -> DataFrame:
    """Distinct point codes and points per block, most occupied first.

    count(distinct) de-duplicates (block, code) map-side before the shuffle,
    so a hot block does not travel as raw rows.
    """
    return (coded.groupBy("blockMortonCode")
                 .agg(F.count_distinct("mortonCode").alias("n_codes"),
                      F.count(F.lit(1)).alias("n_points"))
                 .orderBy(F.desc("n_codes"), F.asc("blockMortonCode")))


def octant_counts(coded: DataFrame) -> DataFrame:
    """Points per code (partial aggregation map-side)."""
    return coded.groupBy("mortonCode").agg(F.count(F.lit(1)).alias("count"))


def octant_total(coded: DataFrame) -> DataFrame:
    """Number of distinct codes, one row."""
    return coded.agg(F.count_distinct("mortonCode").alias("n_octants"))


def block_extent(coded: DataFrame) -> DataFrame:
    """Per-block coordinate extent and point count."""
    return coded.groupBy("blockMortonCode").agg(
        F.min("x").alias("minX"), F.min("y").alias("minY"), F.min("z").alias("minZ"),
        F.max("x").alias("maxX"), F.max("y").alias("maxY"), F.max("z").alias("maxZ"),
        F.count(F.lit(1)).alias("n_points"),
    )


def zorder_topk(coded: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` points in (block, code) order, with every other column as a
    tie-breaker so the answer is deterministic. Planned as a top-k
    (TakeOrderedAndProject): no global sort of the table."""
    order = ["blockMortonCode", "mortonCode", "x", "y", "z", *POINT_FIELDS]
    return coded.orderBy(*order).limit(n)
