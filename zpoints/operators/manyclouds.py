"""Many clouds in one table and one store, each coded in its own extent.

A single cloud's extent is six numbers that enter the plan as literals. With
many clouds the extents are a table, the catalog: a cloud's origin, precision
and span reach its points by a join on the cloud's id (one row per cloud; AQE
broadcasts it when it measures it small). Codes of different clouds overlap, so
everything keyed by a code is keyed by (cloud, code): blocks, files, covers.

The 21-bit check is made twice: the catalog row of a cloud whose extent does
not fit raises, and so does a point outside its cloud's extent, or of a cloud
that is null or has no row in the catalog.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zpoints.functions.zcode import _shr, block_code, with_decoded, with_morton
from zpoints.operators.blocks import POINT_FIELDS, point_struct
from zpoints.operators.bounded import DEFAULT_MAX_PER_ROW, hot_parts
from zpoints.operators.clip import block_cells, box_predicate, box_to_cells, range_join
from zpoints.operators.extent import AXES
from zpoints.plans.cover import CELL_COLS, zranges
from zpoints.schema import BLOCKS, MAX_MASK, PRECISION, RESOLUTION
from zpoints.session import checkpoint_dir

CLOUD = "cloud_id"
CLOUD_BLOCKS = T.StructType([T.StructField(CLOUD, T.LongType()), *BLOCKS.fields])
LIMITS = [f"{m}{a.upper()}" for m in ("min", "max") for a in AXES]


def cloud_extents(points: DataFrame, cloud_id: str, precision: float = PRECISION) -> DataFrame:
    """(cloud_id, minX .. maxZ, precision, n_points): one row per cloud; null ids have none."""
    return (points.where(F.col(cloud_id).isNotNull()).groupBy(F.col(cloud_id).cast("long").alias(CLOUD)).agg(
        *[F.min(a).alias(f"min{a.upper()}") for a in AXES], *[F.max(a).alias(f"max{a.upper()}") for a in AXES],
        F.count(F.lit(1)).alias("n_points")).withColumn("precision", F.lit(float(precision)))
        .select(CLOUD, *LIMITS, "precision", "n_points"))


def _factor() -> Column:
    """Cells per unit, truncated like the factor of a literal precision."""
    return F.floor(1 / F.col("precision")).cast("long")


def checked_catalog(catalog: DataFrame) -> DataFrame:
    """(cloud_id, minX .. maxZ, precision, factor); a cloud whose extent does not fit 21 bits raises."""
    factor = _factor()
    spans = [F.round((F.col(f"max{a.upper()}") - F.col(f"min{a.upper()}")) * factor) for a in AXES]
    too_wide = reduce(lambda a, b: a | b, [s > MAX_MASK for s in spans])
    text = F.concat(F.lit("cloud "), F.col(CLOUD).cast("string"), F.lit(" spans more cells than a code holds: coarsen its precision or split it"))
    return catalog.select(F.when(too_wide, F.raise_error(text)).otherwise(F.col(CLOUD)).cast("long").alias(CLOUD),
                          *LIMITS, "precision", factor.alias("factor"))


def encode_clouds(points: DataFrame, cloud_id: str, catalog: DataFrame | None = None, precision: float = PRECISION,
                  resolution: int = RESOLUTION, keep_cells: bool = False) -> DataFrame:
    """Flat points of many clouds -> coded points with ``cloud_id``, each in the cells of its own cloud.

    ``catalog`` has (cloud_id, minX .. maxZ, precision); it is computed from
    the points when omitted.
    """
    known = checked_catalog(cloud_extents(points, cloud_id, precision) if catalog is None else catalog)
    known = known.withColumnsRenamed({c: f"__{c}" for c in known.columns})
    j = points.join(known, F.col(cloud_id).cast("long") == F.col(f"__{CLOUD}"), "left")
    cell = {f"norm{a.upper()}": F.round((F.col(a) - F.col(f"__min{a.upper()}")) * F.col("__factor")).cast("long") for a in AXES}
    j = j.withColumns(cell)
    named = F.coalesce(F.col(cloud_id).cast("string"), F.lit("null"))
    unknown = F.raise_error(F.concat(F.lit("no extent for cloud "), named))
    outside = F.raise_error(F.concat(F.lit("point outside the 21-bit cell space of cloud "), named))
    bad = reduce(lambda a, b: a | b, [~F.col(n).between(0, MAX_MASK) for n in cell])
    j = j.withColumn("normX", F.when(F.col(f"__{CLOUD}").isNull(), unknown).when(bad, outside).otherwise(F.col("normX")))
    coded = with_morton(j, "normX", "normY", "normZ", out="mortonCode")
    coded = coded.withColumns({"blockMortonCode": block_code("mortonCode", resolution), CLOUD: F.col(f"__{CLOUD}")})
    first = [CLOUD, *AXES, "mortonCode", "blockMortonCode"]
    drop = {f"__{c}" for c in [CLOUD, *LIMITS, "precision", "factor"]} | (set() if keep_cells else set(cell))
    return coded.select(*first, *[c for c in coded.columns if c not in drop and c not in first])


def write_clouds_as_blocks(coded: DataFrame, path: str, max_points_per_row: int = DEFAULT_MAX_PER_ROW,
                           mode: str = "errorifexists") -> None:
    """Coded points of many clouds -> blocks stored by (cloud_id, code): one exchange of the points.

    Range-partitioned by (cloud, block, part) and gathered in place, so a large
    cloud is spread over many files and small ones share a file; row groups
    are skipped by cloud and by code.
    """
    keys = [CLOUD, "blockMortonCode"]
    parted = hot_parts(coded, keys, max_points_per_row)
    cols = keys if parted is None else [*keys, "part"]
    blocks = ((coded if parted is None else parted).repartitionByRange(*cols)
              .groupBy(*cols).agg(F.array_sort(F.collect_list(point_struct())).alias("points")))
    if parted is None:
        blocks = blocks.withColumn("part", F.lit(0))
    (blocks.select(*keys, "part", "points").sortWithinPartitions(*keys, "part").write.mode(mode).parquet(path))


def read_cloud_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLOUD_BLOCKS).parquet(path)


def _unnested(blocks: DataFrame, *carried: str) -> DataFrame:
    return (blocks.select(*carried, CLOUD, "blockMortonCode", F.inline("points"))
            .select(*carried, CLOUD, "coordinates.x", "coordinates.y", "coordinates.z", "mortonCode", "blockMortonCode",
                    *POINT_FIELDS))


def clip_cloud(blocks: DataFrame, catalog: DataFrame, cloud: int, box_min: Sequence[float], box_max: Sequence[float],
               resolution: int = RESOLUTION) -> DataFrame:
    """Exact points of one cloud inside a box in that cloud's coordinates.

    The cloud's catalog row is fetched (one row); cloud id and code ranges are
    pushed to the scan together.
    """
    row = checked_catalog(catalog.where(F.col(CLOUD) == cloud)).first()
    if row is None:
        raise ValueError(f"no extent for cloud {cloud}")
    cells = box_to_cells([row[f"min{a.upper()}"] for a in AXES], box_min, box_max, row["precision"])
    mine = blocks.where(F.col(CLOUD) == cloud)
    if cells is None:
        return _unnested(mine.where(F.lit(False)))
    points = _unnested(mine.where(box_predicate("blockMortonCode", block_cells(cells, resolution))))
    d = with_decoded(points, "mortonCode", out=("__cx", "__cy", "__cz"))
    for a, lo, hi in zip("xyz", *cells):
        d = d.where(F.col(f"__c{a}").between(lo, hi))
    return d.drop("__cx", "__cy", "__cz")


def boxes_in_cells(boxes: DataFrame, catalog: DataFrame) -> DataFrame:
    """(box_id, cloud_id, x0 .. z1): boxes given in their cloud's coordinates
    (box_id, cloud_id, x0, y0, z0, x1, y1, z1 doubles) in that cloud's cells,
    rounded like the points and clamped to the cell space; boxes outside it
    have no row, inverted boxes and boxes of unknown clouds raise."""
    known = checked_catalog(catalog).withColumnRenamed(CLOUD, "__id")
    j = boxes.join(known, F.col(CLOUD).cast("long") == F.col("__id"), "left")
    cell = lambda a, i: F.round((F.col(f"{a}{i}") - F.col(f"min{a.upper()}")) * F.col("factor")).cast("long")
    inverted = reduce(lambda p, q: p | q, [F.col(f"{a}0") > F.col(f"{a}1") for a in AXES])
    problem = F.when(F.col("__id").isNull(), F.raise_error(F.lit("box of a cloud without an extent"))).when(
        inverted, F.raise_error(F.concat(F.lit("inverted box (min > max on an axis), box_id="), F.col("box_id").cast("string"))))
    j = j.select(F.col("__id").alias(CLOUD), "box_id", problem.cast("boolean").alias("__problem"),
                 *[cell(a, i).alias(f"{a}{i}") for i in (0, 1) for a in AXES])
    inside = reduce(lambda p, q: p & q, [(F.col(f"{a}1") >= 0) & (F.col(f"{a}0") <= MAX_MASK) for a in AXES])
    # the test that raises is part of the filter: a row that it stops has no cells to compare
    j = j.where(F.coalesce(F.col("__problem"), inside))
    return j.select("box_id", CLOUD, *[F.greatest(F.lit(0), F.col(f"{a}0")).alias(f"{a}0") for a in AXES],
                                  *[F.least(F.lit(MAX_MASK), F.col(f"{a}1")).alias(f"{a}1") for a in AXES])


def clip_clouds(blocks: DataFrame, catalog: DataFrame, boxes: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """Exact (box_id, point) pairs of a table of boxes, each over its own cloud and in that cloud's coordinates.

    Covers and blocks meet on (cloud, tier, bin): a box is never compared with
    the blocks of another cloud.
    """
    checkpoint_dir(blocks.sparkSession)
    cells = boxes_in_cells(boxes, catalog)
    shifted = cells.select("box_id", *[_shr(F.col(c), resolution).alias(c) for c in CELL_COLS])
    carried = cells.select("box_id", CLOUD, *[F.col(c).alias(f"__b{c}") for c in CELL_COLS])
    joined = range_join(blocks, zranges(shifted).join(carried, "box_id"), "blockMortonCode", keys=(CLOUD,))
    sides = [f"__b{c}" for c in CELL_COLS]
    d = with_decoded(_unnested(joined, "box_id", *sides), "mortonCode", out=("__cx", "__cy", "__cz"))
    for a in "xyz":
        d = d.where(F.col(f"__c{a}").between(F.col(f"__b{a}0"), F.col(f"__b{a}1")))
    return d.drop("__cx", "__cy", "__cz", *sides)
