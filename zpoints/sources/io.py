"""Point text scan, block storage and exports.

Block storage is laid out for data skipping: blocks are range-partitioned by
code (one shuffle, sampled boundaries, so a hot block's parts still spread)
and sorted inside each partition, so every file and row group covers a narrow
code interval and a range predicate skips the rest via parquet statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zpoints.operators.blocks import point_struct, unnest_blocks
from zpoints.operators.bounded import DEFAULT_MAX_PER_ROW, hot_parts
from zpoints.schema import BLOCKS

# The token layout of a text point line.
TEXT_FIELDS = [("x", "double"), ("y", "double"), ("z", "double"),
               ("intensity", "int"), ("red", "short"), ("green", "short"), ("blue", "short")]


def parse_points_text(lines: DataFrame, lenient: bool = False, intensity_type: str = "int") -> DataFrame:
    """Text lines (column ``value``) -> loaded points.

    Tokens are split on a single space and trimmed, then cast. Extra tokens
    are ignored. By default a missing token or a bad number fails the job,
    whatever the session's ANSI setting. ``lenient=True`` yields nulls for
    such fields instead and keeps the row. ``intensity_type`` lets a caller
    read intensity as a byte instead of an int.
    """
    toks = F.split(F.col("value"), " ")
    types = dict(TEXT_FIELDS)
    types["intensity"] = intensity_type

    def field(i, name):
        raw = F.trim(F.get(toks, i))
        value = raw.try_cast(types[name])
        if not lenient:  # raised here, so it does not depend on the session's ANSI mode
            value = F.when(value.isNull(), F.raise_error(F.concat(
                F.lit(f"no valid {name} in point line: "), F.col("value")))).otherwise(value)
        return value.alias(name)

    f = {name: field(i, name) for i, (name, _) in enumerate(TEXT_FIELDS)}
    zero = F.lit(0)
    return lines.select(
        F.struct(f["x"], f["y"], f["z"]).alias("coordinates"),
        F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z")).alias("normalizedCoordinates"),
        F.lit(0).cast("long").alias("mortonCode"),
        F.lit(0).cast("long").alias("blockMortonCode"),
        f["intensity"],
        F.lit(0).cast("byte").alias("classification"),
        f["red"], f["green"], f["blue"],
    )


def read_points_text(spark: SparkSession, path: str, lenient: bool = False, intensity_type: str = "int") -> DataFrame:
    """Text scan of points, one per line: ``x y z intensity red green blue``."""
    return parse_points_text(spark.read.text(path), lenient=lenient, intensity_type=intensity_type)


def points_to_text(points: DataFrame) -> DataFrame:
    """Flat points -> text lines in the scan's layout (lossless for doubles)."""
    return points.select(F.concat_ws(" ", *[F.col(n).cast("string") for n, _ in TEXT_FIELDS]).alias("value"))


def write_points_text(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    points_to_text(points).write.mode(mode).text(path)


def write_blocks(blocks: DataFrame, path: str, mode: str = "errorifexists",
                 num_partitions: int | None = None) -> None:
    """Blocks -> parquet, range-partitioned and sorted by (code, part).

    Without ``num_partitions`` the range shuffle is sized by AQE (partitions
    coalesced towards the advisory size), so file count follows data volume."""
    cols = ("blockMortonCode", "part")
    parted = (blocks.repartitionByRange(num_partitions, *cols) if num_partitions
              else blocks.repartitionByRange(*cols))
    parted.sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def write_points_as_blocks(coded: DataFrame, path: str, mode: str = "errorifexists",
                           max_points_per_row: int = DEFAULT_MAX_PER_ROW) -> None:
    """Coded points -> stored blocks with one shuffle of the points.

    Points are range-partitioned by (block, part); that distribution already
    holds every (block, part) in one partition, so they are gathered in place,
    sorted and written. Files cover disjoint code intervals."""
    blocks = gather_in_place(coded, max_points_per_row)
    blocks.sortWithinPartitions("blockMortonCode", "part").write.mode(mode).parquet(path)


def gather_in_place(coded: DataFrame, max_points_per_row: int = DEFAULT_MAX_PER_ROW) -> DataFrame:
    """Blocks gathered where a range partitioning by (block, part) has put their points: one exchange."""
    parted = hot_parts(coded, ["blockMortonCode"], max_points_per_row)
    cols = ["blockMortonCode"] if parted is None else ["blockMortonCode", "part"]
    rows = (coded if parted is None else parted).repartitionByRange(*cols)
    blocks = rows.groupBy(*cols).agg(F.array_sort(F.collect_list(point_struct())).alias("points"))
    if parted is None:  # a constant part would be folded out of the grouping, and its range partitioning with it
        blocks = blocks.withColumn("part", F.lit(0))
    return blocks.select("blockMortonCode", "part", "points")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path).select(*BLOCKS.names)  # not the folders' column, where files have one


def write_blocks_json(blocks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    blocks.write.mode(mode).json(path)


def read_blocks_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON blocks read back with the explicit schema (inference would widen
    byte and short fields to bigint)."""
    return spark.read.schema(BLOCKS).json(path)


def coarse_prefix(code_col: str = "blockMortonCode", drop_bits: int = 21):
    """Partition column for directory layout: a coarse code prefix (the raw
    code would make one directory per block)."""
    return F.shiftrightunsigned(F.col(code_col), drop_bits)


def write_points_partitioned(coded: DataFrame, path: str, drop_bits: int = 21, mode: str = "overwrite") -> None:
    """Coded points partitioned into directories by a coarse code prefix,
    each directory sorted by code. Overwrite mode, as the original did."""
    out = coded.withColumn("coarse", coarse_prefix("blockMortonCode", drop_bits))
    # range partitioning on (coarse, code) spreads a crowded prefix over many
    # writer tasks (several files in its folder) instead of one
    (out.repartitionByRange("coarse", "mortonCode").sortWithinPartitions("coarse", "mortonCode")
        .write.mode(mode).partitionBy("coarse").parquet(path))


def read_points_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def coarse_filter_for(ranges, drop_bits: int = 21):
    """A predicate on the partition column implied by code ranges, so that
    directory pruning happens before any file is opened. Ranges that fall
    together on the coarse prefix are one term."""
    from zpoints.operators.clip import any_of, merged
    return any_of(F.col("coarse").between(lo, hi)
                  for lo, hi in merged({(lo >> drop_bits, hi >> drop_bits) for lo, hi in ranges}))


def clip_partitioned(points: DataFrame, cells, resolution: int, drop_bits: int = 21) -> DataFrame:
    """Exact points of a box from the partitioned point store: directories are
    pruned by the coarse prefix, row groups by code ranges, points by their cells."""
    from zpoints.operators.clip import block_cells, clip_coded_points, frontier_ranges
    pruned = points.filter(coarse_filter_for(frontier_ranges(block_cells(cells, resolution)), drop_bits))
    return clip_coded_points(pruned, cells, resolution, pushdown=True)


POINT_CSV_SCHEMA = T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()), T.StructField("mortonCode", T.LongType()),
])


def write_points_csv(points: DataFrame, path: str, mode: str = "overwrite") -> None:
    points.select("x", "y", "z", "mortonCode").write.mode(mode).csv(path)


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINT_CSV_SCHEMA).csv(path)


def export_lines(blocks: DataFrame) -> DataFrame:
    """Points of (selected) blocks as ``%.3f %.3f %.3f`` lines, distributed:
    unnest and format on the executors, nothing collected. The value is
    rounded to millimetres first (half up), then printed."""
    pts = unnest_blocks(blocks)
    r = [F.round(F.col(a) * 1000) / 1000 for a in ("x", "y", "z")]
    return pts.select(F.format_string("%.3f %.3f %.3f", *r).alias("value"))


def write_export(blocks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    export_lines(blocks).write.mode(mode).text(path)
