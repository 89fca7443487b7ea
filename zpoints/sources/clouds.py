"""Point clouds derived from the driver's tables.

Each function reads parquet with only the columns it needs (the scan's
ReadSchema is pruned to them) and returns a flat point table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECONDS_IN_WEEK = 7 * 24 * 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud L: one point per lineitem row.

    x = extendedprice / 1000, y = quantity, z = discount * 100,
    intensity = linenumber, colours = supplier, part, order keys mod 256.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_extendedprice") / 1000).alias("x"),
        F.col("l_quantity").cast("double").alias("y"),
        (F.col("l_discount") * 100).alias("z"),
        F.col("l_linenumber").cast("int").alias("intensity"),
        F.lit(0).cast("byte").alias("classification"),
        F.pmod(F.col("l_suppkey"), F.lit(256)).cast("short").alias("red"),
        F.pmod(F.col("l_partkey"), F.lit(256)).cast("short").alias("green"),
        F.pmod(F.col("l_orderkey"), F.lit(256)).cast("short").alias("blue"),
    )


def embeddings_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud E: the first three embedding components of every vector."""
    emb = table(spark, sf_dir, "embeddings")
    e = F.col("embedding")
    return emb.select(
        F.col("vec_id").alias("id"),
        e.getItem(0).cast("double").alias("x"),
        e.getItem(1).cast("double").alias("y"),
        e.getItem(2).cast("double").alias("z"),
    )


def events_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud V: events as (lon, lat, seconds in week). Latitude is linear in
    the value up to 400 and then approaches 90, so any value has a place of its own."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("event_type"),
        (F.pmod(F.col("user_id") * 37, F.lit(360)) - 180).cast("double").alias("lon"),
        F.when(F.col("value") <= 400, F.col("value") * 180 / 500 - 90)
        .otherwise(90 - 14400 / F.col("value")).alias("lat"),
        F.pmod(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000), F.lit(SECONDS_IN_WEEK))
        .cast("long").alias("t"),
    )


def nest_loaded(points: DataFrame) -> DataFrame:
    """Flat points -> the loaded-point shape (nested coordinates, zero codes)."""
    zero = F.lit(0)
    return points.select(
        F.struct("x", "y", "z").alias("coordinates"),
        F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z")).alias("normalizedCoordinates"),
        F.lit(0).cast("long").alias("mortonCode"),
        F.lit(0).cast("long").alias("blockMortonCode"),
        "intensity", "classification", "red", "green", "blue",
    )


def flatten_loaded(points: DataFrame) -> DataFrame:
    """Loaded-point shape -> flat points (the flatten projection)."""
    return points.select(
        "coordinates.x", "coordinates.y", "coordinates.z",
        "intensity", "classification", "red", "green", "blue",
    )
