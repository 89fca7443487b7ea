"""Fixed schemas and constants of the point model."""

from __future__ import annotations

from pyspark.sql import types as T

# Quantisation precision (metres per integer cell) and the
# default block resolution (a block is 2**resolution cells per axis).
PRECISION = 0.001
RESOLUTION = 8

# Fixed values of the octree cover: search depth below the common prefix,
# by the number of shared prefix bits: fewer than 30 -> 7 levels, fewer than
# 40 -> 6 levels, otherwise 5 levels.
DEPTH_LIMITS = [(30, 7), (40, 6)]
DEPTH_LIMIT_DEFAULT = 5

# Fixed values of the 3-D Morton code: 21 bits per axis, 63 in total.
MAX_DIM = 3
MAX_BITS = 21
TOTAL_BITS = MAX_BITS * MAX_DIM
MAX_MASK = (1 << MAX_BITS) - 1
LONG_MAX = (1 << 63) - 1


def precision_factor(precision: float = PRECISION) -> int:
    """Cells per unit, truncated to an int: 1 / 0.001 -> 1000."""
    return int(1 / precision)


XYZ_DOUBLE = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
])

XYZ_INT = T.StructType([
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("z", T.IntegerType()),
])

# A loaded point: nested coordinates, codes zero until computed.
LOADED_POINT = T.StructType([
    T.StructField("coordinates", XYZ_DOUBLE),
    T.StructField("normalizedCoordinates", XYZ_INT),
    T.StructField("mortonCode", T.LongType()),
    T.StructField("blockMortonCode", T.LongType()),
    T.StructField("intensity", T.IntegerType()),
    T.StructField("classification", T.ByteType()),
    T.StructField("red", T.ShortType()),
    T.StructField("green", T.ShortType()),
    T.StructField("blue", T.ShortType()),
])

# A coded point, flat: the table the pipeline works on.
CODED_POINT_COLUMNS = [
    "x", "y", "z", "mortonCode", "blockMortonCode",
    "intensity", "classification", "red", "green", "blue",
]

# Point as stored inside a block. normalizedCoordinates is not stored (it
# was always zero); it can be recovered from mortonCode by decoding.
BLOCK_POINT = T.StructType([
    T.StructField("mortonCode", T.LongType()),
    T.StructField("coordinates", XYZ_DOUBLE),
    T.StructField("intensity", T.IntegerType()),
    T.StructField("classification", T.ByteType()),
    T.StructField("red", T.ShortType()),
    T.StructField("green", T.ShortType()),
    T.StructField("blue", T.ShortType()),
])

# One row per block (or per part of a block that is too large for one row).
BLOCKS = T.StructType([
    T.StructField("blockMortonCode", T.LongType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("points", T.ArrayType(BLOCK_POINT)),
])

BOX = T.StructType([
    T.StructField("box_id", T.IntegerType()),
    T.StructField("min", XYZ_DOUBLE),
    T.StructField("max", XYZ_DOUBLE),
])

RANGE = T.StructType([
    T.StructField("box_id", T.IntegerType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
])

CATALOG = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("resolution", T.IntegerType()),
    T.StructField("extent", T.StructType([
        T.StructField("min", XYZ_DOUBLE),
        T.StructField("max", XYZ_DOUBLE),
    ])),
    T.StructField("offsets", XYZ_DOUBLE),
    T.StructField("scaleFactors", XYZ_DOUBLE),
])
