"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the driver's tables (lineitem, embeddings, events, nation)
at ``sf_dir`` and runs over them whole. Oracles are written from the
definitions (bit loops, brute-force joins, enumerated cells, a recursive
octree walk), not from the Spark plans.
"""

from __future__ import annotations

import atexit
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zpoints.functions import spacetime as ST
from zpoints.functions import zcode as Z
from zpoints.operators import blocks as BL
from zpoints.operators import clip as CL
from zpoints.operators import extent as EX
from zpoints.operators import neighbours as NB
from zpoints.operators import ranges as RG
from zpoints.operators import stats as SS
from zpoints.plans import cover as CV
from zpoints.session import checkpoint_dir
from zpoints.sources import clouds as CD
from zpoints.sources import io as IO
from zpoints.streaming import ingest as SI

# Fixed values of the test fixtures: box B1 in point cells relative to the
# extent minimum, the radius for cloud E, the export / cube parameters.
B1 = ((17000, 2000, 0), (23000, 7000, 7000))
RADIUS = 0.05
CUBE_HALF_WIDTH = 3000
COARSE_RES = 13
ST_BOX = ((-100.0, 60.0), (-30.0, 45.0), (86400, 4 * 86400))
ST_WIDE = ((-200.0, 60.0), (-90.0, -10.0), (0, 604800))
# A box of hundreds of blocks a side; a box in coordinates; a fixed extent
# that leaves points outside; a low cap on rows per array.
B_LARGE = ((300, 300, 300), (100000, 45000, 9500))
COORD_BOX = ((20.0, 5.0, 1.0), (60.5, 30.2, 6.0))
FIXED_EXTENT = {"minX": 5.0, "minY": 3.0, "minZ": 1.0, "maxX": 105.0, "maxY": 50.0, "maxZ": 10.0}
HOT_CAP = 50
CODE_RADIUS = 0.05

Query = Callable[[SparkSession, str], DataFrame]


_scratch: dict[str, SparkSession] = {}


def _remove_scratch() -> None:
    for path, spark in _scratch.items():
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)
        except Exception:  # the JVM is gone: nothing is left to delete with
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory, removed when the driver exits."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch[path] = spark
    return path


def _L(spark, sf):
    return CD.lineitem_cloud(spark, sf)


def _coded(spark, sf, resolution=8, keep_cells=False):
    return EX.encode_points(_L(spark, sf), resolution=resolution, keep_cells=keep_cells)


def _blocks(spark, sf):
    return BL.collect_blocks(_coded(spark, sf))


def _stored_blocks(spark, sf):
    """Ingest: blocks written to parquet (range-partitioned by code), then
    read back; box queries run against the stored table, where the cover
    predicate reaches the parquet scan."""
    path = scratch_path(spark, "blocks")
    IO.write_points_as_blocks(_coded(spark, sf), path)
    return IO.read_blocks(spark, path)


def _block_summary(blocks: DataFrame) -> DataFrame:
    p = F.col("points")
    return blocks.select(
        "blockMortonCode", "part",
        F.size(p).alias("n_points"),
        Z.code_sum(p["mortonCode"]).alias("code_sum"),
        F.aggregate(p, F.lit(0).cast("long"), lambda acc, e: acc + e["intensity"]).alias("intensity_sum"),
        p.getItem(0)["mortonCode"].alias("first_code"),
        F.element_at(p, -1)["mortonCode"].alias("last_code"),
        p.getItem(0)["coordinates"]["x"].alias("first_x"),
    )


POINT10 = ["x", "y", "z", "mortonCode", "blockMortonCode", "intensity", "classification", "red", "green", "blue"]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def q_pts_parse(spark, sf):
    path = scratch_path(spark, "pts")
    IO.write_points_text(_L(spark, sf), path)
    return CD.flatten_loaded(IO.read_points_text(spark, path))


def q_extent(spark, sf):
    return EX.extent(_L(spark, sf))


def q_extent_normalized(spark, sf):
    e = EX.extent(_L(spark, sf))
    return EX.extent_normalized(EX.extent_normalized(e), compat=True, suffix="_compat")


def q_normalize_coords(spark, sf):
    return EX.normalize_coords(_L(spark, sf))


def q_morton_encode(spark, sf):
    n = EX.normalize_coords(_L(spark, sf))
    return Z.with_morton(n, "normX", "normY", "normZ").select("x", "y", "z", "normX", "normY", "normZ", "mortonCode")


def q_block_code(spark, sf):
    return _coded(spark, sf).select(*POINT10)


def q_morton_decode(spark, sf):
    c = _coded(spark, sf)
    return Z.with_decoded(c, "mortonCode", out=("cx", "cy", "cz")).select("mortonCode", "cx", "cy", "cz")


def q_blocks_collect(spark, sf):
    return _block_summary(_blocks(spark, sf))


def q_codes_per_block(spark, sf):
    b = BL.codes_per_block(_coded(spark, sf))
    m = F.col("mortonCodes")
    return b.select("blockMortonCode", "part", F.size(m).alias("n_codes"),
                    Z.code_sum(m).alias("code_sum"),
                    m.getItem(0).alias("first_code"), F.element_at(m, -1).alias("last_code"))


def q_blocks_roundtrip(spark, sf):
    path = scratch_path(spark, "blocks")
    IO.write_blocks(_blocks(spark, sf), path)
    return BL.unnest_blocks(IO.read_blocks(spark, path))


def q_blocks_json_roundtrip(spark, sf):
    path = scratch_path(spark, "blocks-json")
    IO.write_blocks_json(_blocks(spark, sf), path)
    return BL.unnest_blocks(IO.read_blocks_json(spark, path))


def q_coarse_partition_roundtrip(spark, sf):
    path = scratch_path(spark, "coarse")
    IO.write_points_partitioned(_coded(spark, sf).select(*POINT10), path)
    back = IO.read_points_partitioned(spark, path)
    return back.select(*POINT10, F.col("coarse").cast("long").alias("coarse"))


def q_stream_blocks_ingest(spark, sf):
    """The lineitem cloud as a file stream: encoded against its extent (a
    one-row aggregate of the static table), gathered into blocks per
    micro-batch, written, and read back as points."""
    src = scratch_path(spark, "stream-src")
    IO.write_points_text(_L(spark, sf), src)
    ext = EX.extent_values(_L(spark, sf))
    stream = CD.flatten_loaded(SI.read_points_text_stream(spark, src, max_files_per_trigger=4))
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = SI.start_block_ingest(SI.encode_stream(stream, ext), out, ckpt, available_now=True)
    q.awaitTermination()
    return BL.unnest_blocks(SI.read_stream_blocks(spark, out))


def q_clip_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "clip-csv")
    IO.write_points_csv(CL.clip_coded_points(_coded(spark, sf, keep_cells=True), B1), path)
    return IO.read_points_csv(spark, path)


def q_clip_blocks(spark, sf):
    return _block_summary(CL.clip_blocks_cells(_stored_blocks(spark, sf), CL.block_cells(B1)))


def q_sql_clip(spark, sf):
    blocks = _stored_blocks(spark, sf)
    return _sql_clip(spark, blocks, CL.block_cells(B1))


def _sql_clip(spark, blocks, bcells):
    view = f"blocks_{uuid.uuid4().hex[:12]}"
    blocks.createOrReplaceTempView(view)
    where = CL.box_predicate_sql("blockMortonCode", bcells)
    return spark.sql(f"SELECT blockMortonCode, part, size(points) AS n_points FROM {view} WHERE {where}")


def q_clip_large_box(spark, sf):
    return _block_summary(CL.clip_blocks_cells(_stored_blocks(spark, sf), CL.block_cells(B_LARGE)))


def q_sql_clip_large_box(spark, sf):
    return _sql_clip(spark, _stored_blocks(spark, sf), CL.block_cells(B_LARGE))


def q_clip_box_coords(spark, sf):
    """Blocks of a box in coordinates, with rounded and with truncated corners."""
    blocks = _stored_blocks(spark, sf)
    e = EX.extent_values(_L(spark, sf))
    low = (e["minX"], e["minY"], e["minZ"])
    both = [_block_summary(CL.clip(blocks, low, *COORD_BOX, compat=c)).withColumn("compat", F.lit(c)) for c in (False, True)]
    return both[0].unionByName(both[1])


def q_coarse_partition_clip(spark, sf):
    path = scratch_path(spark, "coarse")
    IO.write_points_partitioned(_coded(spark, sf).select(*POINT10), path)
    return IO.clip_partitioned(IO.read_points_partitioned(spark, path), B1, 8).select(*POINT10)


def q_quarantine_points(spark, sf):
    """Points coded against a fixed extent; those outside its cells are set apart."""
    inside, outside = EX.split_outside(_L(spark, sf), FIXED_EXTENT)
    return inside.select("x", "y", "z", "mortonCode", F.lit(False).alias("quarantined")).unionByName(
        outside.select("x", "y", "z", F.lit(None).cast("long").alias("mortonCode"), F.lit(True).alias("quarantined")))


def _hot_summary(parts, size, total):
    return parts.groupBy("blockMortonCode").agg(
        F.sum(size).alias("n_points"), Z.sum_of_codes(total).alias("code_sum"),
        (F.max(size) <= HOT_CAP).alias("within_cap"), (F.count_distinct("part") == F.count("*")).alias("parts_differ"),
        F.min(size >= 1).alias("none_empty"))


def q_blocks_hot_parts(spark, sf):
    p = F.col("points")
    blocks = BL.collect_blocks(_coded(spark, sf, resolution=COARSE_RES), max_points_per_row=HOT_CAP)
    return _hot_summary(blocks, F.size(p), Z.code_sum(p["mortonCode"]))


def q_codes_hot_parts(spark, sf):
    m = F.col("mortonCodes")
    codes = BL.codes_per_block(_coded(spark, sf, resolution=COARSE_RES), max_per_row=HOT_CAP)
    return _hot_summary(codes, F.size(m), Z.code_sum(m))


def q_pts_parse_byte(spark, sf):
    path = scratch_path(spark, "pts")
    IO.write_points_text(_L(spark, sf), path)
    return CD.flatten_loaded(IO.read_points_text(spark, path, intensity_type="byte"))


def q_scale_points_catalog(spark, sf):
    """Fixed-point scaling with factors of each point's own cloud, from a catalog of clouds."""
    c = _coded(spark, sf)
    catalog = SS.cloud_catalog(c, "intensity", "lineitem").select(
        "id", *[(F.col(f"scale{a}") * F.col("id")).alias(f"scale{a}") for a in "XYZ"])
    return EX.scale_points_by_catalog(_L(spark, sf), catalog, "intensity")


def q_radius_join_codes(spark, sf):
    """Pairs of point codes of the lineitem cloud within a radius."""
    return NB.radius_join(_coded(spark, sf), CODE_RADIUS, id_col="mortonCode")


def q_range_coalesce_top(spark, sf):
    """Ranges that end at or near the top code."""
    top = F.lit((1 << 63) - 1)
    r = CD.table(spark, sf, "lineitem").select(
        "l_returnflag", (top - 4 * F.col("l_orderkey")).alias("lo"),
        (top - F.greatest(4 * F.col("l_orderkey") - 4 * F.col("l_linenumber"), F.lit(0))).alias("hi"))
    return RG.coalesce_ranges(r, groups=["l_returnflag"])


def _stored_events(spark, sf):
    path = scratch_path(spark, "events")
    ST.write_events(CD.events_cloud(spark, sf), path)
    return spark.read.parquet(path)


def q_st_box_wide(spark, sf):
    return ST.st_box_filter(_stored_events(spark, sf), *ST_WIDE).select("id", "event_type", "lon", "lat", "t")


def q_clip_points(spark, sf):
    return CL.clip_points(_stored_blocks(spark, sf), B1).select(*POINT10)


def _nation_boxes(spark, sf):
    n = CD.table(spark, sf, "nation")
    return n.select(
        F.col("n_nationkey").alias("box_id"),
        (F.col("n_nationkey") * 4000).cast("long").alias("x0"),
        (F.col("n_regionkey") * 8000).cast("long").alias("y0"),
        (F.col("n_regionkey") * 1500).cast("long").alias("z0"),
        (F.col("n_nationkey") * 4000 + 7999).cast("long").alias("x1"),
        (F.col("n_regionkey") * 8000 + 11999).cast("long").alias("y1"),
        (F.col("n_regionkey") * 1500 + 4999).cast("long").alias("z1"),
    )


def q_clip_many_boxes(spark, sf):
    out = CL.clip_many_boxes(_coded(spark, sf), _nation_boxes(spark, sf))
    return out.select("box_id", "x", "y", "z", "mortonCode")


def q_clip_export(spark, sf):
    return IO.export_lines(CL.clip_blocks_cells(_stored_blocks(spark, sf), CL.block_cells(B1)))


def q_cube_around_point(spark, sf):
    # the centre is the middle cell of the extent: a one-row aggregate
    e = EX.extent_normalized(EX.extent(_L(spark, sf))).first()
    center = tuple(int(e[f"size{a}"]) // 2 for a in "XYZ")
    cells = CL.cube_cells(center, CUBE_HALF_WIDTH)
    return CL.clip_coded_points(_coded(spark, sf, keep_cells=True), cells).select(*POINT10)


def _coarse_boxes(spark, sf):
    """One box per coarse block: the block-space extent of its points."""
    c = _coded(spark, sf, keep_cells=True)
    sh = lambda n: F.shiftright(F.col(n), 8)
    return (c.groupBy(Z.block_code("mortonCode", COARSE_RES).alias("box_id"))
             .agg(F.min(sh("normX")).alias("x0"), F.min(sh("normY")).alias("y0"), F.min(sh("normZ")).alias("z0"),
                  F.max(sh("normX")).alias("x1"), F.max(sh("normY")).alias("y1"), F.max(sh("normZ")).alias("z1")))


def q_zranges_cover(spark, sf):
    r = CV.zranges(_coarse_boxes(spark, sf))
    return r.withColumn("length", RG.range_length())


def _key_ranges(spark, sf):
    li = CD.table(spark, sf, "lineitem")
    return li.select("l_returnflag", F.col("l_orderkey").alias("lo"),
                     (F.col("l_orderkey") + F.col("l_linenumber") - 1).alias("hi"))


def q_range_coalesce(spark, sf):
    return RG.coalesce_ranges(_key_ranges(spark, sf), groups=["l_returnflag"])


def _block_code_span(spark, sf):
    return (_coded(spark, sf).groupBy("blockMortonCode")
            .agg(F.min("mortonCode").alias("lo"), F.max("mortonCode").alias("hi")))


def q_common_prefix(spark, sf):
    s = _block_code_span(spark, sf).withColumn("__cp", Z.common_prefix("lo", "hi"))
    return s.select("blockMortonCode", "lo", "hi", F.col("__cp.prefix").alias("prefix"),
                    F.col("__cp.bits").alias("bits"), Z.depth_limit(F.col("__cp.bits")).alias("depth_limit"))


def q_range_relations(spark, sf):
    c = _coded(spark, sf)
    a_lo, a_hi = F.col("mortonCode") - 5000, F.col("mortonCode") + 5000
    b_lo = F.shiftleft(F.col("blockMortonCode"), 24)
    b_hi = b_lo + (1 << 23)
    return c.select(
        "mortonCode", "x", "y", "z",
        Z.range_contains(b_lo, b_hi, F.col("mortonCode")).alias("b_contains_code"),
        Z.range_contains_range(b_lo, b_hi, a_lo, a_hi).alias("b_contains_a"),
        Z.range_overlaps(a_lo, a_hi, b_lo, b_hi).alias("overlaps"),
        Z.range_overlaps_compat(b_lo, b_hi, a_lo, a_hi).alias("overlaps_compat"),
    )


def q_range_relations_3d(spark, sf):
    c = _coded(spark, sf)
    blk = c.groupBy("blockMortonCode").agg(F.min("mortonCode").alias("a_lo"), F.max("mortonCode").alias("a_hi"))
    par = (c.groupBy(Z.block_code("mortonCode", COARSE_RES).alias("parent"))
            .agg(F.min("mortonCode").alias("b_lo"), F.max("mortonCode").alias("b_hi")))
    j = blk.withColumn("parent", F.shiftrightunsigned("blockMortonCode", 3 * (COARSE_RES - 8))).join(par, "parent")
    return j.select(
        "blockMortonCode", "a_lo", "a_hi", "b_lo", "b_hi",
        Z.range_contains_in_user_space("b_lo", "b_hi", "a_lo", "a_hi").alias("b_contains_a"),
        Z.range_contains_in_user_space("a_lo", "a_hi", "b_lo", "b_hi").alias("a_contains_b"),
        Z.range_overlaps_in_user_space("a_lo", "a_hi", "b_lo", "b_hi").alias("overlap"),
    )


def q_code_in_box(spark, sf):
    (x0, y0, z0), (x1, y1, z1) = B1
    lo = Z.morton_code(F.lit(x0), F.lit(y0), F.lit(z0))
    hi = Z.morton_code(F.lit(x1), F.lit(y1), F.lit(z1))
    c = _coded(spark, sf)
    return c.select("mortonCode", "x", "y", "z", Z.code_in_box("mortonCode", lo, hi).alias("in_box"))


def q_code_midpoint(spark, sf):
    s = _block_code_span(spark, sf)
    return s.select("blockMortonCode", "lo", "hi", Z.code_midpoint("lo", "hi").alias("mid"))


def _small_boxes(spark, sf):
    n = CD.table(spark, sf, "nation")
    x0 = F.col("n_nationkey") * 3500 + 1000
    y0 = F.col("n_nationkey") * 1500 + 2000
    z0 = F.col("n_nationkey") * 300 + 500
    return n.select(F.col("n_nationkey").alias("box_id"),
                    Z.morton_code(x0, y0, z0).alias("zmin"),
                    Z.morton_code(x0 + 15, y0 + 15, z0 + 15).alias("zmax"))


def q_chunk_prune(spark, sf):
    chunks = (_coded(spark, sf).groupBy(F.shiftrightunsigned("mortonCode", 33).alias("chunk_id"))
              .agg(F.min("mortonCode").alias("lo"), F.max("mortonCode").alias("hi")))
    return RG.chunk_prune(chunks, _small_boxes(spark, sf)).select("chunk_id", "box_id", "lo", "hi")


def q_range_cut(spark, sf):
    chunks = (_coded(spark, sf).groupBy(F.shiftrightunsigned("mortonCode", 6).alias("chunk_id"))
              .agg(F.min("mortonCode").alias("lo"), F.max("mortonCode").alias("hi")))
    chunks = chunks.withColumn("pivot", F.floor((F.col("lo") + F.col("hi")) / 2).cast("long"))
    return RG.cut_ranges(chunks).select("chunk_id", "lo", "hi", "pivot", "piece", "cut_lo", "cut_hi")


def q_block_occupancy(spark, sf):
    return BL.block_occupancy(_coded(spark, sf, resolution=COARSE_RES))


def q_octant_counts(spark, sf):
    return BL.octant_counts(_coded(spark, sf))


def q_octant_total(spark, sf):
    return BL.octant_total(_coded(spark, sf))


def q_zorder_topk(spark, sf):
    return BL.zorder_topk(_coded(spark, sf), 20).select(*POINT10)


def q_describe_xyz(spark, sf):
    return SS.describe(_coded(spark, sf), ["x", "y", "z"])


def q_describe_octants(spark, sf):
    c = _coded(spark, sf)
    codes = c.agg(
        F.count("mortonCode").alias("count_mortonCode"),
        F.round(F.avg(F.col("mortonCode").cast("decimal(38,0)")).cast("double"), 0).alias("mean_mortonCode"),
        F.round(F.stddev_samp("mortonCode") / 1e6, 3).alias("stddev_mortonCode_m"),
        F.min("mortonCode").alias("min_mortonCode"), F.max("mortonCode").alias("max_mortonCode"),
    )
    counts = EX.one_row(SS.describe(BL.octant_counts(c), ["count"]))
    names = [f"{k}_count" for k in ("count", "mean", "stddev", "min", "max")]
    return codes.select("*", *[counts[n].alias(n) for n in names])


def q_block_extent(spark, sf):
    return BL.block_extent(_coded(spark, sf))


def q_cloud_catalog(spark, sf):
    return SS.cloud_catalog(_coded(spark, sf), "intensity", "lineitem")


def q_radius_join(spark, sf):
    return NB.radius_join(CD.embeddings_cloud(spark, sf), RADIUS)


def q_neighbour_lists(spark, sf):
    nl = NB.neighbour_lists(NB.radius_join(CD.embeddings_cloud(spark, sf), RADIUS))
    m = F.col("neighbours")
    return nl.select("current", "part", F.size(m).alias("n_near"),
                     F.aggregate(m, F.lit(0).cast("long"), lambda a, e: a + e).alias("near_sum"),
                     m.getItem(0).alias("first_near"), F.element_at(m, -1).alias("last_near"))


def q_scale_points(spark, sf):
    return EX.scale_points(_L(spark, sf), 0.001)


def q_scaled_codes(spark, sf):
    s = EX.scaled_codes(EX.scale_points(_L(spark, sf), 0.001))
    return s.select("X", "Y", "Z", "tX", "tY", "tZ", "mortonCode", "blockMortonCode", "intensity")


def q_st_index(spark, sf):
    return ST.st_index(CD.events_cloud(spark, sf))


def q_st_invert(spark, sf):
    c = ST.st_index(CD.events_cloud(spark, sf))
    return ST.st_invert(c).select("id", "stCode", "lonInv", "latInv", "tInv")


def q_st_box_filter(spark, sf):
    return ST.st_box_filter(_stored_events(spark, sf), *ST_BOX).select("id", "event_type", "lon", "lat", "t")


QUERIES: dict[str, Query] = {
    "pts_parse": q_pts_parse,
    "extent": q_extent,
    "extent_normalized": q_extent_normalized,
    "normalize_coords": q_normalize_coords,
    "morton_encode": q_morton_encode,
    "block_code": q_block_code,
    "morton_decode": q_morton_decode,
    "blocks_collect": q_blocks_collect,
    "codes_per_block": q_codes_per_block,
    "blocks_roundtrip": q_blocks_roundtrip,
    "blocks_json_roundtrip": q_blocks_json_roundtrip,
    "coarse_partition_roundtrip": q_coarse_partition_roundtrip,
    "stream_blocks_ingest": q_stream_blocks_ingest,
    "clip_csv_roundtrip": q_clip_csv_roundtrip,
    "clip_blocks": q_clip_blocks,
    "sql_clip": q_sql_clip,
    "clip_points": q_clip_points,
    "clip_many_boxes": q_clip_many_boxes,
    "clip_export": q_clip_export,
    "cube_around_point": q_cube_around_point,
    "zranges_cover": q_zranges_cover,
    "range_coalesce": q_range_coalesce,
    "common_prefix": q_common_prefix,
    "range_relations": q_range_relations,
    "range_relations_3d": q_range_relations_3d,
    "code_in_box": q_code_in_box,
    "code_midpoint": q_code_midpoint,
    "chunk_prune": q_chunk_prune,
    "range_cut": q_range_cut,
    "block_occupancy": q_block_occupancy,
    "octant_counts": q_octant_counts,
    "octant_total": q_octant_total,
    "zorder_topk": q_zorder_topk,
    "describe_xyz": q_describe_xyz,
    "describe_octants": q_describe_octants,
    "block_extent": q_block_extent,
    "cloud_catalog": q_cloud_catalog,
    "radius_join": q_radius_join,
    "neighbour_lists": q_neighbour_lists,
    "scale_points": q_scale_points,
    "scaled_codes": q_scaled_codes,
    "st_index": q_st_index,
    "st_invert": q_st_invert,
    "st_box_filter": q_st_box_filter,
    "st_box_wide": q_st_box_wide,
    "clip_large_box": q_clip_large_box,
    "sql_clip_large_box": q_sql_clip_large_box,
    "clip_box_coords": q_clip_box_coords,
    "coarse_partition_clip": q_coarse_partition_clip,
    "quarantine_points": q_quarantine_points,
    "blocks_hot_parts": q_blocks_hot_parts,
    "codes_hot_parts": q_codes_hot_parts,
    "pts_parse_byte": q_pts_parse_byte,
    "scale_points_catalog": q_scale_points_catalog,
    "radius_join_codes": q_radius_join_codes,
    "range_coalesce_top": q_range_coalesce_top,
}


# ---------------------------------------------------------------------------
# Oracle side (DuckDB SQL)
# ---------------------------------------------------------------------------

def s_enc(a: str, b: str, c: str) -> str:
    """Morton code in SQL as a loop over the 21 bit positions."""
    return ("CAST(list_sum(list_transform(range(21), lambda i: "
            f"(((({a}) >> i) & 1) << (3 * i)) | (((({b}) >> i) & 1) << (3 * i + 1)) "
            f"| (((({c}) >> i) & 1) << (3 * i + 2)))) AS BIGINT)")


def s_dec(code: str, d: int) -> str:
    """Axis d of a code in SQL, bit by bit."""
    return f"CAST(list_sum(list_transform(range(21), lambda i: (((({code}) >> (3 * i + {d})) & 1) << i))) AS BIGINT)"


L_CTE = """L AS (SELECT l_extendedprice / 1000 AS x, CAST(l_quantity AS DOUBLE) AS y, l_discount * 100 AS z,
  CAST(l_linenumber AS INTEGER) AS intensity, CAST(0 AS TINYINT) AS classification,
  CAST(l_suppkey % 256 AS SMALLINT) AS red, CAST(l_partkey % 256 AS SMALLINT) AS green,
  CAST(l_orderkey % 256 AS SMALLINT) AS blue FROM lineitem)"""
EXT_CTE = """EXT AS (SELECT min(x) AS minX, min(y) AS minY, min(z) AS minZ,
  max(x) AS maxX, max(y) AS maxY, max(z) AS maxZ FROM L)"""
N_CTE = """N AS (SELECT L.*, CAST(round((x - minX) * 1000) AS BIGINT) AS normX,
  CAST(round((y - minY) * 1000) AS BIGINT) AS normY, CAST(round((z - minZ) * 1000) AS BIGINT) AS normZ FROM L, EXT)"""
C_CTE = f"C AS (SELECT N.*, {s_enc('normX', 'normY', 'normZ')} AS mortonCode FROM N)"
P_CTE = "P AS (SELECT C.*, mortonCode >> 24 AS blockMortonCode FROM C)"
BASE = ",\n".join([L_CTE, EXT_CTE, N_CTE, C_CTE, P_CTE])
S_POINT10 = "x, y, z, mortonCode, blockMortonCode, intensity, classification, red, green, blue"
E_CTE = """E AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
  CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"""
V_CTE = """V AS (SELECT event_id AS id, event_type, CAST((user_id * 37) % 360 - 180 AS DOUBLE) AS lon,
  CASE WHEN value <= 400 THEN value * 180 / 500 - 90 ELSE 90 - 14400 / value END AS lat, CAST(floor(epoch(ts)) AS BIGINT) % 604800 AS t FROM events)"""
RADIUS_SQL = f"CAST({RADIUS} AS DOUBLE) * CAST({RADIUS} AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _b1_where(prefix: str = "") -> str:
    (x0, y0, z0), (x1, y1, z1) = B1
    return (f"{prefix}normX BETWEEN {x0} AND {x1} AND {prefix}normY BETWEEN {y0} AND {y1} "
            f"AND {prefix}normZ BETWEEN {z0} AND {z1}")


def _b1_blocks_where(box=B1) -> str:
    (x0, y0, z0), (x1, y1, z1) = CL.block_cells(box)
    return (f"(normX >> 8) BETWEEN {x0} AND {x1} AND (normY >> 8) BETWEEN {y0} AND {y1} "
            f"AND (normZ >> 8) BETWEEN {z0} AND {z1}")


BLOCK_SUMMARY_SQL = """SELECT blockMortonCode, CAST(0 AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_points,
  CAST(sum(mortonCode) AS BIGINT) AS code_sum, CAST(sum(intensity) AS BIGINT) AS intensity_sum,
  min(mortonCode) AS first_code, max(mortonCode) AS last_code,
  arg_min(x, struct_pack(c := mortonCode, x := x)) AS first_x
FROM {src} GROUP BY blockMortonCode"""


def _sql_zranges_cover() -> str:
    cells = lambda o: [s_dec(o, d) for d in range(3)]
    ox, oy, oz = cells("o.omin")
    side = "(CAST(1 AS BIGINT) << (o.off // 3))"
    inside = " AND ".join(f"{v} >= o.{a}0 AND {v} + {side} - 1 <= o.{a}1" for v, a in zip((ox, oy, oz), "xyz"))
    overlap = " AND ".join(f"greatest({v}, o.{a}0) <= least({v} + {side} - 1, o.{a}1)"
                           for v, a in zip((ox, oy, oz), "xyz"))
    return (
        "WITH RECURSIVE " + ",\n".join([L_CTE, EXT_CTE, N_CTE, C_CTE]) + ",\n" + f"""
BX AS (SELECT mortonCode >> {3 * COARSE_RES} AS box_id, min(normX >> 8) AS x0, min(normY >> 8) AS y0,
  min(normZ >> 8) AS z0, max(normX >> 8) AS x1, max(normY >> 8) AS y1, max(normZ >> 8) AS z1 FROM C GROUP BY 1),
BZ AS (SELECT *, {s_enc('x0', 'y0', 'z0')} AS zmin, {s_enc('x1', 'y1', 'z1')} AS zmax FROM BX),
BS AS (SELECT *, list_min(list_filter(range(0, 64, 3), lambda s: (zmin >> s) = (zmax >> s))) AS sh FROM BZ),
ROOT AS (SELECT box_id, x0, y0, z0, x1, y1, z1,
  CASE WHEN 63 - sh < 30 THEN 7 WHEN 63 - sh < 40 THEN 6 ELSE 5 END AS lim,
  CASE WHEN sh >= 63 THEN 0 ELSE (zmin >> sh) << sh END AS omin, sh AS off FROM BS),
OCT(box_id, x0, y0, z0, x1, y1, z1, lim, omin, off, lvl) AS (
  SELECT box_id, x0, y0, z0, x1, y1, z1, lim, omin, off, 0 FROM ROOT
  UNION ALL
  SELECT o.box_id, o.x0, o.y0, o.z0, o.x1, o.y1, o.z1, o.lim,
    o.omin | (CAST(k.c AS BIGINT) << (o.off - 3)), o.off - 3, o.lvl + 1
  FROM OCT o, (SELECT unnest(range(8)) AS c) k
  WHERE NOT ({inside}) AND ({overlap}) AND o.lvl < o.lim AND o.off > 0
),
EM AS (SELECT o.box_id, o.omin AS lo, o.omin + ((CAST(1 AS BIGINT) << o.off) - 1) AS hi FROM OCT o
  WHERE ({inside}) OR (({overlap}) AND NOT (o.lvl < o.lim AND o.off > 0))),
M1 AS (SELECT *, max(hi) OVER (PARTITION BY box_id ORDER BY lo, hi
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM EM),
M2 AS (SELECT *, sum(CASE WHEN pm IS NULL OR lo > pm + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY box_id
  ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS isl FROM M1)
SELECT box_id, min(lo) AS lo, max(hi) AS hi, max(hi) - min(lo) + 1 AS length FROM M2 GROUP BY box_id, isl""")


def _sql_range_cut() -> str:
    dec = lambda c: [s_dec(c, d) for d in range(3)]
    lx, ly, lz = dec("lo")
    hx, hy, hz = dec("hi")
    px, py, pz = dec('"pivot"')
    return _with(BASE, f"""CH AS (SELECT mortonCode >> 6 AS chunk_id, min(mortonCode) AS lo, max(mortonCode) AS hi
  FROM P GROUP BY 1),
CP AS (SELECT *, CAST(floor((lo + hi) / 2) AS BIGINT) AS "pivot" FROM CH),
CB AS (SELECT *, {lx} AS lx, {ly} AS ly, {lz} AS lz, {hx} AS hx, {hy} AS hy, {hz} AS hz,
  {px} AS px, {py} AS py, {pz} AS pz FROM CP),
CELLS AS (SELECT chunk_id, {s_enc('gx', 'gy', 'gz')} AS code FROM
  (SELECT chunk_id, unnest(range(lx, hx + 1)) AS gx, ly, hy, lz, hz FROM CB) a,
  LATERAL (SELECT unnest(range(ly, hy + 1)) AS gy) b, LATERAL (SELECT unnest(range(lz, hz + 1)) AS gz) c),
DV AS (SELECT CB.chunk_id, coalesce(max(code) FILTER (WHERE code < "pivot"), 0) AS litmax,
  coalesce(min(code) FILTER (WHERE code > "pivot"), 0) AS bigmin
  FROM CB JOIN CELLS ON CB.chunk_id = CELLS.chunk_id GROUP BY CB.chunk_id),
K AS (SELECT CB.*, DV.litmax, DV.bigmin, (px BETWEEN lx AND hx AND py BETWEEN ly AND hy AND pz BETWEEN lz AND hz) AS inb
  FROM CB JOIN DV ON CB.chunk_id = DV.chunk_id)
SELECT chunk_id, lo, hi, "pivot", 0 AS piece, hi AS cut_lo, hi AS cut_hi FROM K WHERE lo <> hi AND inb AND "pivot" = lo
UNION ALL SELECT chunk_id, lo, hi, "pivot", 0, lo, lo FROM K WHERE lo <> hi AND inb AND "pivot" = hi AND "pivot" <> lo
UNION ALL SELECT chunk_id, lo, hi, "pivot", 0, lo, "pivot" - 1 FROM K WHERE lo <> hi AND inb AND "pivot" <> lo AND "pivot" <> hi
UNION ALL SELECT chunk_id, lo, hi, "pivot", 1, "pivot" + 1, hi FROM K WHERE lo <> hi AND inb AND "pivot" <> lo AND "pivot" <> hi
UNION ALL SELECT chunk_id, lo, hi, "pivot", 0, lo, litmax FROM K WHERE lo <> hi AND NOT inb
UNION ALL SELECT chunk_id, lo, hi, "pivot", 1, bigmin, hi FROM K WHERE lo <> hi AND NOT inb""")


def _sql_range_relations_3d() -> str:
    dec = lambda c: [s_dec(c, d) for d in range(3)]
    al, ah, bl, bh = dec("a_lo"), dec("a_hi"), dec("b_lo"), dec("b_hi")

    def contains(outer_lo, outer_hi, inner):
        return " AND ".join(f"{inner[d]} BETWEEN {outer_lo[d]} AND {outer_hi[d]}" for d in range(3))

    b_has_a = f"({contains(bl, bh, al)}) AND ({contains(bl, bh, ah)})"
    a_has_b = f"({contains(al, ah, bl)}) AND ({contains(al, ah, bh)})"
    overlap = " AND ".join(f"greatest({al[d]}, {bl[d]}) <= least({ah[d]}, {bh[d]})" for d in range(3))
    return _with(BASE, f"""BLK AS (SELECT blockMortonCode, min(mortonCode) AS a_lo, max(mortonCode) AS a_hi
  FROM P GROUP BY 1),
PAR AS (SELECT mortonCode >> {3 * COARSE_RES} AS parent, min(mortonCode) AS b_lo, max(mortonCode) AS b_hi
  FROM P GROUP BY 1)""") + f"""SELECT blockMortonCode, a_lo, a_hi, b_lo, b_hi, {b_has_a} AS b_contains_a,
  {a_has_b} AS a_contains_b, {overlap} AS overlap
FROM BLK JOIN PAR ON (BLK.blockMortonCode >> {3 * (COARSE_RES - 8)}) = PAR.parent"""


def _sql_code_midpoint() -> str:
    mids = [f"(({s_dec('lo', d)} + {s_dec('hi', d)}) // 2)" for d in range(3)]
    return _with(BASE, "S AS (SELECT blockMortonCode, min(mortonCode) AS lo, max(mortonCode) AS hi FROM P GROUP BY 1)") + \
        f"SELECT blockMortonCode, lo, hi, {s_enc(*mids)} AS mid FROM S"


def _sql_chunk_prune() -> str:
    return _with(BASE, f"""CH AS (SELECT mortonCode >> 33 AS chunk_id, min(mortonCode) AS lo, max(mortonCode) AS hi
  FROM P GROUP BY 1),
BX AS (SELECT n_nationkey AS box_id, n_nationkey * 3500 + 1000 AS x0, n_nationkey * 1500 + 2000 AS y0,
  n_nationkey * 300 + 500 AS z0 FROM nation),
CELLS AS (SELECT box_id, {s_enc('gx', 'gy', 'gz')} AS code FROM
  (SELECT box_id, unnest(range(CAST(x0 AS BIGINT), CAST(x0 AS BIGINT) + 16)) AS gx, y0, z0 FROM BX) a,
  LATERAL (SELECT unnest(range(CAST(y0 AS BIGINT), CAST(y0 AS BIGINT) + 16)) AS gy) b,
  LATERAL (SELECT unnest(range(CAST(z0 AS BIGINT), CAST(z0 AS BIGINT) + 16)) AS gz) c)""") + \
        """SELECT DISTINCT CH.chunk_id, CELLS.box_id, CH.lo, CH.hi FROM CH JOIN CELLS
  ON CELLS.code BETWEEN CH.lo AND CH.hi"""


def _sql_common_prefix() -> str:
    return _with(BASE, """S AS (SELECT blockMortonCode, min(mortonCode) AS lo, max(mortonCode) AS hi FROM P GROUP BY 1),
T AS (SELECT *, list_min(list_filter(range(0, 64, 3), lambda s: (lo >> s) = (hi >> s))) AS sh FROM S)""") + \
        """SELECT blockMortonCode, lo, hi, CASE WHEN sh >= 63 THEN 0 ELSE (lo >> sh) << sh END AS prefix,
  CAST(63 - sh AS INTEGER) AS bits,
  CASE WHEN 63 - sh < 30 THEN 7 WHEN 63 - sh < 40 THEN 6 ELSE 5 END AS depth_limit FROM T"""


def _sql_describe(src: str, cols, digits=6) -> str:
    parts = []
    for c in cols:
        parts += [f"count({c}) AS count_{c}", f"round(avg({c}), {digits}) AS mean_{c}",
                  f"round(stddev_samp({c}), {digits}) AS stddev_{c}",
                  f"CAST(min({c}) AS DOUBLE) AS min_{c}", f"CAST(max({c}) AS DOUBLE) AS max_{c}"]
    return f"SELECT {', '.join(parts)} FROM {src}"


def _sql_st_index_cte() -> str:
    return V_CTE + """,
VN AS (SELECT *, CAST(ceil((CAST(180.0 AS DOUBLE) + lon) / 360.0 * 2097151) AS INTEGER) AS nLon,
  CAST(ceil((CAST(90.0 AS DOUBLE) + lat) / 180.0 * 2097151) AS INTEGER) AS nLat,
  greatest(0, CAST(ceil(t / CAST(604800.0 AS DOUBLE) * 1048575) AS INTEGER)) AS nT FROM V),
VC AS (SELECT *, """ + s_enc("CAST(nLon AS BIGINT)", "CAST(nLat AS BIGINT)", "CAST(nT AS BIGINT)") + " AS stCode FROM VN)"


ORACLES: dict[str, str] = {
    "pts_parse": _with(L_CTE) + "SELECT x, y, z, intensity, classification, red, green, blue FROM L",
    "extent": _with(L_CTE, EXT_CTE) + "SELECT * FROM EXT",
    "extent_normalized": _with(L_CTE, EXT_CTE) + """SELECT *,
  CAST(round((maxX - minX) * 1000) AS BIGINT) AS sizeX, CAST(round((maxY - minY) * 1000) AS BIGINT) AS sizeY,
  CAST(round((maxZ - minZ) * 1000) AS BIGINT) AS sizeZ,
  CAST(trunc(maxX - minX) AS BIGINT) * 1000 AS sizeX_compat, CAST(trunc(maxY - minY) AS BIGINT) * 1000 AS sizeY_compat,
  CAST(trunc(maxZ - minZ) AS BIGINT) * 1000 AS sizeZ_compat FROM EXT""",
    "normalize_coords": _with(L_CTE, EXT_CTE, N_CTE) + "SELECT * FROM N",
    "morton_encode": _with(L_CTE, EXT_CTE, N_CTE, C_CTE) + "SELECT x, y, z, normX, normY, normZ, mortonCode FROM C",
    "block_code": _with(BASE) + f"SELECT {S_POINT10} FROM P",
    "morton_decode": _with(BASE) + """SELECT mortonCode, CAST(normX AS INTEGER) AS cx, CAST(normY AS INTEGER) AS cy,
  CAST(normZ AS INTEGER) AS cz FROM P""",
    "blocks_collect": _with(BASE) + BLOCK_SUMMARY_SQL.format(src="P"),
    "codes_per_block": _with(BASE) + """SELECT blockMortonCode, CAST(0 AS INTEGER) AS part,
  CAST(count(*) AS INTEGER) AS n_codes, CAST(sum(mortonCode) AS BIGINT) AS code_sum,
  min(mortonCode) AS first_code, max(mortonCode) AS last_code FROM P GROUP BY blockMortonCode""",
    "blocks_roundtrip": _with(BASE) + f"SELECT {S_POINT10} FROM P",
    "blocks_json_roundtrip": _with(BASE) + f"SELECT {S_POINT10} FROM P",
    "coarse_partition_roundtrip": _with(BASE) + f"SELECT {S_POINT10}, blockMortonCode >> 21 AS coarse FROM P",
    "stream_blocks_ingest": _with(BASE) + f"SELECT {S_POINT10} FROM P",
    "clip_csv_roundtrip": _with(BASE) + f"SELECT x, y, z, mortonCode FROM P WHERE {_b1_where()}",
    "clip_blocks": _with(BASE) + BLOCK_SUMMARY_SQL.format(src=f"(SELECT * FROM P WHERE {_b1_blocks_where()})"),
    "sql_clip": _with(BASE) + f"""SELECT blockMortonCode, CAST(0 AS INTEGER) AS part,
  CAST(count(*) AS INTEGER) AS n_points FROM P WHERE {_b1_blocks_where()} GROUP BY blockMortonCode""",
    "clip_points": _with(BASE) + f"SELECT {S_POINT10} FROM P WHERE {_b1_where()}",
    "clip_many_boxes": _with(BASE) + """SELECT n_nationkey AS box_id, x, y, z, mortonCode FROM P JOIN nation ON
  normX BETWEEN n_nationkey * 4000 AND n_nationkey * 4000 + 7999
  AND normY BETWEEN n_regionkey * 8000 AND n_regionkey * 8000 + 11999
  AND normZ BETWEEN n_regionkey * 1500 AND n_regionkey * 1500 + 4999""",
    "clip_export": _with(BASE) + f"""SELECT printf('%.3f %.3f %.3f', round(x * 1000) / 1000, round(y * 1000) / 1000,
  round(z * 1000) / 1000) AS value FROM P WHERE {_b1_blocks_where()}""",
    "cube_around_point": _with(BASE, """CT AS (SELECT CAST(round((maxX - minX) * 1000) AS BIGINT) // 2 AS cx,
  CAST(round((maxY - minY) * 1000) AS BIGINT) // 2 AS cy, CAST(round((maxZ - minZ) * 1000) AS BIGINT) // 2 AS cz
  FROM EXT)""") + f"""SELECT {S_POINT10} FROM P, CT WHERE normX BETWEEN cx - {CUBE_HALF_WIDTH} AND cx + {CUBE_HALF_WIDTH}
  AND normY BETWEEN cy - {CUBE_HALF_WIDTH} AND cy + {CUBE_HALF_WIDTH}
  AND normZ BETWEEN cz - {CUBE_HALF_WIDTH} AND cz + {CUBE_HALF_WIDTH}""",
    "zranges_cover": _sql_zranges_cover(),
    "range_coalesce": """WITH R AS (SELECT l_returnflag, l_orderkey AS lo, l_orderkey + l_linenumber - 1 AS hi
  FROM lineitem),
M1 AS (SELECT *, max(hi) OVER (PARTITION BY l_returnflag ORDER BY lo, hi
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM R),
M2 AS (SELECT *, sum(CASE WHEN pm IS NULL OR lo > pm + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_returnflag
  ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS isl FROM M1)
SELECT l_returnflag, min(lo) AS lo, max(hi) AS hi FROM M2 GROUP BY l_returnflag, isl""",
    "common_prefix": _sql_common_prefix(),
    "range_relations": _with(BASE) + """SELECT mortonCode, x, y, z,
  mortonCode BETWEEN (blockMortonCode << 24) AND (blockMortonCode << 24) + 8388608 AS b_contains_code,
  (mortonCode - 5000 BETWEEN (blockMortonCode << 24) AND (blockMortonCode << 24) + 8388608)
   AND (mortonCode + 5000 BETWEEN (blockMortonCode << 24) AND (blockMortonCode << 24) + 8388608) AS b_contains_a,
  (mortonCode - 5000 <= (blockMortonCode << 24) + 8388608) AND ((blockMortonCode << 24) <= mortonCode + 5000) AS overlaps,
  (mortonCode - 5000 BETWEEN (blockMortonCode << 24) AND (blockMortonCode << 24) + 8388608)
   OR (mortonCode + 5000 BETWEEN (blockMortonCode << 24) AND (blockMortonCode << 24) + 8388608) AS overlaps_compat
FROM P""",
    "range_relations_3d": _sql_range_relations_3d(),
    "code_in_box": _with(BASE) + f"SELECT mortonCode, x, y, z, ({_b1_where()}) AS in_box FROM P",
    "code_midpoint": _sql_code_midpoint(),
    "chunk_prune": _sql_chunk_prune(),
    "range_cut": _sql_range_cut(),
    "block_occupancy": _with(BASE) + f"""SELECT mortonCode >> {3 * COARSE_RES} AS blockMortonCode,
  count(DISTINCT mortonCode) AS n_codes, count(*) AS n_points FROM P GROUP BY 1""",
    "octant_counts": _with(BASE) + "SELECT mortonCode, count(*) AS count FROM P GROUP BY mortonCode",
    "octant_total": _with(BASE) + "SELECT count(DISTINCT mortonCode) AS n_octants FROM P",
    "zorder_topk": _with(BASE) + f"""SELECT {S_POINT10} FROM P ORDER BY blockMortonCode, mortonCode, x, y, z,
  intensity, classification, red, green, blue LIMIT 20""",
    "describe_xyz": _with(BASE) + _sql_describe("P", ["x", "y", "z"]),
    "describe_octants": _with(BASE, "OC AS (SELECT mortonCode, count(*) AS count FROM P GROUP BY mortonCode)") +
    """SELECT * FROM (SELECT count(mortonCode) AS count_mortonCode,
  round(CAST(avg(CAST(mortonCode AS HUGEINT)) AS DOUBLE), 0) AS mean_mortonCode,
  round(stddev_samp(mortonCode) / 1e6, 3) AS stddev_mortonCode_m,
  min(mortonCode) AS min_mortonCode, max(mortonCode) AS max_mortonCode FROM P) a, (""" +
    _sql_describe("OC", ["count"]) + ") b",
    "block_extent": _with(BASE) + """SELECT blockMortonCode, min(x) AS minX, min(y) AS minY, min(z) AS minZ,
  max(x) AS maxX, max(y) AS maxY, max(z) AS maxZ, count(*) AS n_points FROM P GROUP BY blockMortonCode""",
    "cloud_catalog": _with(BASE) + """SELECT intensity AS id, 'lineitem-' || CAST(intensity AS VARCHAR) AS name,
  8 AS resolution, min(x) AS minX, min(y) AS minY, min(z) AS minZ, max(x) AS maxX, max(y) AS maxY, max(z) AS maxZ,
  min(x) AS offsetX, min(y) AS offsetY, min(z) AS offsetZ, CAST(0.001 AS DOUBLE) AS scaleX,
  CAST(0.001 AS DOUBLE) AS scaleY, CAST(0.001 AS DOUBLE) AS scaleZ, count(*) AS n_points,
  count(DISTINCT blockMortonCode) AS n_blocks FROM P GROUP BY intensity""",
    "radius_join": _with(E_CTE) + f"""SELECT a.id AS current, b.id AS nearPoint FROM E a, E b
  WHERE (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z) <= {RADIUS_SQL}""",
    "neighbour_lists": _with(E_CTE, f"""PR AS (SELECT a.id AS current, b.id AS nearPoint FROM E a, E b
  WHERE (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z) <= {RADIUS_SQL})""") +
    """SELECT current, CAST(0 AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_near,
  CAST(sum(nearPoint) AS BIGINT) AS near_sum, min(nearPoint) AS first_near, max(nearPoint) AS last_near
FROM PR GROUP BY current""",
    "scale_points": _with(L_CTE) + """SELECT CAST(trunc(x * 1000.0) AS INTEGER) AS X, CAST(trunc(y * 1000.0) AS INTEGER) AS Y,
  CAST(trunc(z * 1000.0) AS INTEGER) AS Z, CAST(1 AS TINYINT) AS classification, intensity, red, green, blue FROM L""",
    "scaled_codes": _with(L_CTE, """S AS (SELECT CAST(trunc(x * 1000.0) AS INTEGER) AS X,
  CAST(trunc(y * 1000.0) AS INTEGER) AS Y, CAST(trunc(z * 1000.0) AS INTEGER) AS Z, intensity FROM L),
SM AS (SELECT min(X) AS mX, min(Y) AS mY, min(Z) AS mZ FROM S),
T AS (SELECT S.*, X - mX AS tX, Y - mY AS tY, Z - mZ AS tZ FROM S, SM)""") +
    f"""SELECT X, Y, Z, tX, tY, tZ, {s_enc('CAST(tX AS BIGINT)', 'CAST(tY AS BIGINT)', 'CAST(tZ AS BIGINT)')} AS mortonCode,
  {s_enc('CAST(tX AS BIGINT)', 'CAST(tY AS BIGINT)', 'CAST(tZ AS BIGINT)')} >> 24 AS blockMortonCode, intensity FROM T""",
    "st_index": _with(_sql_st_index_cte()) + "SELECT * FROM VC",
    "st_invert": _with(_sql_st_index_cte()) + f"""SELECT id, stCode,
  ({s_dec('stCode', 0)} / CAST(2097151 AS DOUBLE)) * 360.0 - 180.0 AS lonInv,
  ({s_dec('stCode', 1)} / CAST(2097151 AS DOUBLE)) * 180.0 - 90.0 AS latInv,
  CAST(trunc({s_dec('stCode', 2)} * CAST(604800.0 AS DOUBLE) / CAST(1048575 AS DOUBLE)) AS BIGINT) AS tInv FROM VC""",
    "st_box_filter": _with(V_CTE) + f"""SELECT id, event_type, lon, lat, t FROM V
  WHERE lon BETWEEN {ST_BOX[0][0]} AND {ST_BOX[0][1]} AND lat BETWEEN {ST_BOX[1][0]} AND {ST_BOX[1][1]}
  AND t BETWEEN {ST_BOX[2][0]} AND {ST_BOX[2][1]}""",
    "st_box_wide": _with(V_CTE) + f"""SELECT id, event_type, lon, lat, t FROM V
  WHERE lon BETWEEN {ST_WIDE[0][0]} AND {ST_WIDE[0][1]} AND lat BETWEEN {ST_WIDE[1][0]} AND {ST_WIDE[1][1]}
  AND t BETWEEN {ST_WIDE[2][0]} AND {ST_WIDE[2][1]}""",
    "clip_large_box": _with(BASE) + BLOCK_SUMMARY_SQL.format(src=f"(SELECT * FROM P WHERE {_b1_blocks_where(B_LARGE)})"),
    "sql_clip_large_box": _with(BASE) + f"""SELECT blockMortonCode, CAST(0 AS INTEGER) AS part,
  CAST(count(*) AS INTEGER) AS n_points FROM P WHERE {_b1_blocks_where(B_LARGE)} GROUP BY blockMortonCode""",
    "clip_box_coords": _with(BASE) + " UNION ALL ".join(
        f"SELECT *, {str(c).upper()} AS compat FROM (" + BLOCK_SUMMARY_SQL.format(src="(SELECT P.* FROM P, EXT WHERE " + " AND ".join(
            f"(norm{a} >> 8) BETWEEN (CAST({f}(({lo} - min{a}) * 1000) AS BIGINT) >> 8) "
            f"AND (CAST({f}(({hi} - min{a}) * 1000) AS BIGINT) >> 8)"
            for a, lo, hi in zip("XYZ", *COORD_BOX)) + ")") + ")" for c, f in ((False, "round"), (True, "trunc"))),
    "coarse_partition_clip": _with(BASE) + f"SELECT {S_POINT10} FROM P WHERE {_b1_where()}",
    "quarantine_points": _with(L_CTE, "Q AS (SELECT x, y, z, " + ", ".join(
        f"CAST(round(({a} - {FIXED_EXTENT[f'min{a.upper()}']}) * 1000) AS BIGINT) AS n{a}" for a in "xyz") + " FROM L)",
        "R AS (SELECT *, NOT (nx BETWEEN 0 AND 2097151 AND ny BETWEEN 0 AND 2097151 AND nz BETWEEN 0 AND 2097151) AS quarantined FROM Q)")
    + f"SELECT x, y, z, CASE WHEN NOT quarantined THEN {s_enc('nx', 'ny', 'nz')} END AS mortonCode, quarantined FROM R",
    **{q: _with(BASE) + f"""SELECT mortonCode >> {3 * COARSE_RES} AS blockMortonCode, count(*) AS n_points,
  CAST(sum(mortonCode) AS BIGINT) AS code_sum, TRUE AS within_cap, TRUE AS parts_differ, TRUE AS none_empty FROM P GROUP BY 1"""
       for q in ("blocks_hot_parts", "codes_hot_parts")},
    "pts_parse_byte": _with(L_CTE) + """SELECT x, y, z, CAST(intensity AS TINYINT) AS intensity, classification,
  red, green, blue FROM L""",
    "scale_points_catalog": _with(L_CTE) + "SELECT " + ", ".join(
        f"CAST(trunc({a} * (1 / (CAST(0.001 AS DOUBLE) * intensity))) AS INTEGER) AS {a.upper()}" for a in "xyz")
    + ", CAST(1 AS TINYINT) AS classification, intensity, red, green, blue FROM L",
    "radius_join_codes": _with(BASE) + f"""SELECT a.mortonCode AS current, b.mortonCode AS nearPoint FROM P a JOIN P b
  ON b.x BETWEEN a.x - 0.06 AND a.x + 0.06
  WHERE (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z)
  <= CAST({CODE_RADIUS} AS DOUBLE) * CAST({CODE_RADIUS} AS DOUBLE)""",
    "range_coalesce_top": """WITH R AS (SELECT l_returnflag, 9223372036854775807 - 4 * l_orderkey AS lo,
  9223372036854775807 - greatest(4 * l_orderkey - 4 * l_linenumber, 0) AS hi FROM lineitem),
M1 AS (SELECT *, max(hi) OVER (PARTITION BY l_returnflag ORDER BY lo, hi
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM R),
M2 AS (SELECT *, sum(CASE WHEN pm IS NULL OR lo - 1 > pm THEN 1 ELSE 0 END) OVER (PARTITION BY l_returnflag
  ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS isl FROM M1)
SELECT l_returnflag, min(lo) AS lo, max(hi) AS hi FROM M2 GROUP BY l_returnflag, isl""",
}
