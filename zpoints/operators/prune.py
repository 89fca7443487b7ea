"""Pruning a stored table by a table of boxes: a runtime filter taken from data, and a zone map of the store's files.

A literal box becomes a predicate before the query runs (``operators.clip``).
A *table* of boxes is known only at run time, so a plain join would scan the
whole store. Two ways make the scan small:

* ``coarse_ranges`` reduces the Z-ranges of all boxes to at most 32 by keeping
  the widest gaps between them. The gaps are found where the ranges lie
  sorted; only the widest of every partition reach the driver. Their OR is an
  ordinary predicate on the code column, so parquet skips row groups by it.
* A *zone map* is a small table written beside the store: file, zone (a run of
  rows of the file), least and greatest code, rows. Zones are joined with
  the boxes by BIGMIN (``chunk_prune``), and only files with a surviving zone
  are opened. This tells apart files that the 32 coarse ranges cannot.

Both only leave out what cannot match; the exact test per point follows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zpoints.functions.zcode import _shr, morton_code, with_decoded
from zpoints.operators.clip import MAX_OR_TERMS, range_join, ranges_sql
from zpoints.operators.ranges import chunk_prune, coalesce_ranges
from zpoints.plans.cover import CELL_COLS, validate_cells, zranges
from zpoints.schema import BLOCKS, RESOLUTION
from zpoints.session import checkpoint_dir

ZONE_ROWS = 65_536

_GAPS = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                      T.StructField("before", T.LongType()), T.StructField("after", T.LongType())])


def _widest_gaps(most: int):
    """Per partition of disjoint ranges sorted by lo: one row with its span, then its ``most`` widest gaps."""
    def run(it):
        import numpy as np
        import pandas as pd
        span, kept = None, pd.DataFrame({"before": [], "after": []}, dtype="int64")
        for pdf in it:
            if not len(pdf):
                continue
            lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
            before, after = hi[:-1], lo[1:]
            if span is not None:  # the gap across the border of two Arrow batches
                before, after = np.concatenate([[span[1]], before]), np.concatenate([[lo[0]], after])
            span = (lo[0] if span is None else span[0], hi[-1])
            kept = pd.concat([kept, pd.DataFrame({"before": before, "after": after})], ignore_index=True)
            order = np.argsort(-(kept["after"] - kept["before"]).to_numpy(), kind="stable")
            kept = kept.iloc[order[:most]].reset_index(drop=True)
        if span is not None:
            yield pd.DataFrame({"first": [span[0]], "last": [span[1]], "before": [None], "after": [None]}).astype("Int64")
            if len(kept):
                yield kept.assign(first=None, last=None)[["first", "last", "before", "after"]].astype("Int64")
    return run


def coarse_ranges(ranges: DataFrame, max_terms: int = MAX_OR_TERMS) -> list[tuple[int, int]]:
    """At most ``max_terms`` ranges (lo, hi) that hold every range of the table, with the widest gaps left open.

    The ranges are merged and sorted across partitions; each partition sends
    its span and its ``max_terms - 1`` widest gaps, so the driver sees at most
    ``max_terms`` rows per partition, whatever the number of boxes.
    """
    merged = coalesce_ranges(ranges.select("lo", "hi"), groups=[])
    found = (merged.repartitionByRange("lo").sortWithinPartitions("lo")
             .mapInPandas(_widest_gaps(max_terms - 1), _GAPS).collect())
    spans = sorted((r["first"], r["last"]) for r in found if r["first"] is not None)
    if not spans:
        return []
    gaps = [(r["before"], r["after"]) for r in found if r["before"] is not None]
    gaps += [(a[1], b[0]) for a, b in zip(spans, spans[1:])]
    keep = sorted(heapq.nlargest(max_terms - 1, gaps, key=lambda g: (g[1] - g[0], -g[0])))
    return list(zip([spans[0][0], *(g[1] for g in keep)], [*(g[0] for g in keep), spans[-1][1]]))


def _block_boxes(boxes: DataFrame, resolution: int, keep: tuple[str, ...] = ()) -> DataFrame:
    return boxes.select("box_id", *keep, *[_shr(F.col(c).cast("long"), resolution).alias(c) for c in CELL_COLS])


def clip_many_boxes_blocks(blocks: DataFrame, boxes: DataFrame, resolution: int = RESOLUTION,
                           max_terms: int = MAX_OR_TERMS) -> DataFrame:
    """Exact (box_id, point) pairs for a table of boxes in point cells over a stored blocks table.

    The covers of all boxes are pinned once (a checkpoint). Their coarse
    ranges are a pushed predicate of the scan; the blocks that pass are joined
    with the covers, unnested, and each point is tested against its box.
    """
    checkpoint_dir(blocks.sparkSession)
    cover = zranges(_block_boxes(boxes, resolution)).join(
        boxes.select("box_id", *[F.col(c).cast("long").alias(f"__b{c}") for c in CELL_COLS]), on="box_id")
    cover = cover.checkpoint(eager=True)
    pruned = blocks.filter(ranges_sql("blockMortonCode", coarse_ranges(cover, max_terms)))
    return exact_points_of_boxes(range_join(pruned, cover, "blockMortonCode"))


def exact_points_of_boxes(joined: DataFrame) -> DataFrame:
    """Blocks joined with covers that carry their box (``__bx0`` .. ``__bz1``) -> (box_id, point) pairs, tested per point."""
    carried = ["box_id", *[f"__b{c}" for c in CELL_COLS]]
    points = (joined.select(*carried, "blockMortonCode", F.inline("points"))
              .select(*carried, "coordinates.x", "coordinates.y", "coordinates.z", "mortonCode", "blockMortonCode",
                      "intensity", "classification", "red", "green", "blue"))
    d = with_decoded(points, "mortonCode", out=("__cx", "__cy", "__cz"))
    for a in "xyz":
        d = d.filter(F.col(f"__c{a}").between(F.col(f"__b{a}0"), F.col(f"__b{a}1")))
    return d.drop("__cx", "__cy", "__cz", *[f"__b{c}" for c in CELL_COLS])


# ---------------------------------------------------------------------------
# Zone maps
# ---------------------------------------------------------------------------

def write_zone_map(spark: SparkSession, store: str, zone_map: str, code_col: str = "blockMortonCode",
                   zone_rows: int = ZONE_ROWS, mode: str = "errorifexists") -> None:
    """Write (file, zone, lo, hi, rows) of a parquet store, ``zone_rows`` rows of a file to a zone, sorted by lo.

    Reads the code column only; aggregation is partial in the task that reads the file.
    """
    rows = spark.read.parquet(store).select(
        F.col(code_col).alias("code"), F.col("_metadata.file_path").alias("file"),
        F.floor(F.col("_metadata.row_index") / zone_rows).cast("int").alias("zone"))
    zones = rows.groupBy("file", "zone").agg(F.min("code").alias("lo"), F.max("code").alias("hi"), F.count("*").alias("rows"))
    (zones.repartitionByRange("lo", "file").sortWithinPartitions("lo", "file").write.mode(mode).parquet(zone_map))


def read_zone_map(spark: SparkSession, zone_map: str) -> DataFrame:
    return spark.read.schema("file string, zone int, lo long, hi long, rows long").parquet(zone_map)


def zones_of_boxes(zones: DataFrame, boxes: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """(file, zone, rows, box_id): zones that may hold a block of a box (boxes in point cells), by BIGMIN."""
    corners = validate_cells(_block_boxes(boxes, resolution)).select(
        "box_id", morton_code("x0", "y0", "z0").alias("zmin"), morton_code("x1", "y1", "z1").alias("zmax"))
    return chunk_prune(zones.where(F.col("lo").isNotNull()), corners).select("file", "zone", "rows", "box_id")


def read_through_zones(spark: SparkSession, store: str, zone_map: str, boxes: DataFrame, resolution: int = RESOLUTION,
                       schema: T.StructType = BLOCKS) -> DataFrame:
    """The store's blocks from the files that may hold a block of one of the boxes; other files are not opened.

    The list of surviving files is fetched: part of the file listing that a
    scan of the whole store would hold on the driver. A file of the store that
    the map does not know raises, so a map older than the store cannot lose rows.
    """
    zones = read_zone_map(spark, zone_map)
    known = {r["file"] for r in zones.select("file").distinct().collect()}
    unknown = {_plain(f) for f in spark.read.schema(schema).parquet(store).inputFiles()} - {_plain(f) for f in known}
    if unknown:
        raise ValueError(f"the zone map does not cover {len(unknown)} files of the store, such as {min(unknown)}: write it again")
    files = sorted(r["file"] for r in zones_of_boxes(zones, boxes, resolution).select("file").distinct().collect())
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)


def _plain(uri: str) -> str:
    """A file URI in one spelling (``file:/x`` and ``file:///x`` are the same file)."""
    scheme, found, rest = uri.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if found and not rest.lstrip("/").startswith("//") and scheme == "file" else uri


def clip_through_zones(spark: SparkSession, store: str, zone_map: str, boxes: DataFrame,
                       resolution: int = RESOLUTION) -> DataFrame:
    """Exact (box_id, point) pairs of a table of boxes, opening only the files that the zone map leaves."""
    return clip_many_boxes_blocks(read_through_zones(spark, store, zone_map, boxes, resolution), boxes, resolution)
