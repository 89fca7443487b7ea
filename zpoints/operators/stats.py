"""Summary statistics and the cloud catalog."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zpoints.schema import PRECISION, RESOLUTION


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """count, mean, stddev (sample), min, max per column, as one numeric row
    (``DataFrame.describe`` returns strings). One pass, partial aggregation."""
    def r(c):
        return F.round(c, digits) if digits is not None else c
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"count_{c}"), r(F.avg(c)).alias(f"mean_{c}"),
            r(F.stddev_samp(c)).alias(f"stddev_{c}"),
            F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}"),
        ]
    return df.agg(*aggs)


def cloud_catalog(coded: DataFrame, cloud_id: str, name: str, resolution: int = RESOLUTION,
                  precision: float = PRECISION, offsets: Mapping[str, float] | None = None) -> DataFrame:
    """One catalog row per cloud: id, name, resolution, extent, offsets (the
    extent minimum unless given), scale factors (the precision), and point
    and block counts."""
    agg = coded.groupBy(cloud_id).agg(
        F.min("x").alias("minX"), F.min("y").alias("minY"), F.min("z").alias("minZ"),
        F.max("x").alias("maxX"), F.max("y").alias("maxY"), F.max("z").alias("maxZ"),
        F.count(F.lit(1)).alias("n_points"),
        F.count_distinct("blockMortonCode").alias("n_blocks"),
    )
    off = offsets or {}
    return agg.select(
        F.col(cloud_id).alias("id"),
        F.concat(F.lit(name), F.lit("-"), F.col(cloud_id).cast("string")).alias("name"),
        F.lit(resolution).alias("resolution"),
        "minX", "minY", "minZ", "maxX", "maxY", "maxZ",
        *[(F.lit(float(off[a])) if a in off else F.col(f"min{a.upper()}")).alias(f"offset{a.upper()}")
          for a in ("x", "y", "z")],
        *[F.lit(float(precision)).alias(f"scale{a.upper()}") for a in ("x", "y", "z")],
        "n_points", "n_blocks",
    )


def nest_catalog(flat: DataFrame) -> DataFrame:
    """Flat catalog rows -> the nested catalog schema (extent/offsets/scales
    as structs)."""
    xyz = lambda p: F.struct(*[F.col(f"{p}{a}").alias(a.lower()) for a in ("X", "Y", "Z")])
    return flat.select(
        F.col("id").cast("int").alias("id"), "name", "resolution",
        F.struct(xyz("min").alias("min"), xyz("max").alias("max")).alias("extent"),
        xyz("offset").alias("offsets"), xyz("scale").alias("scaleFactors"),
    )
