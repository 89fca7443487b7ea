"""Registered queries over stored tables, range sets and many clouds, with their DuckDB oracles.

The helpers and fixture values are those of ``zpoints.registry``; the two
registries are put together in ``zpoints.queries``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zpoints import registry as R
from zpoints.functions import spacetime as ST
from zpoints.functions import sqlfuncs as SQ
from zpoints.operators import clip as CL
from zpoints.operators import manyclouds as MC
from zpoints.operators import octree as OT
from zpoints.operators import prune as PR
from zpoints.operators import ranges as RG
from zpoints.sources import clouds as CD
from zpoints.sources import generations as GN
from zpoints.sources import io as IO
from zpoints.streaming import ingest as SI
from zpoints.streaming import rangeset as RS

# A box a little short of an aligned size on every axis; files of the zone-mapped store.
B_SHORT = ((0, 0, 0), (65532, 32667, 8190))
STORE_FILES = 16
# One cloud's box in its own coordinates; octree leaf capacity and file size in points.
CLOUD_BOX = (3, (20.0, 5.0, 1.0), (60.5, 30.2, 6.0))
LEAF_CAP, FILE_POINTS = 100, 1500
# A box across the antimeridian and the end of the week.
PERIODIC_BOX = ((150.0, -120.0), (-45.0, 60.0), (5 * 86400, 86400))


def q_clip_short_box(spark, sf):
    return CL.clip_points(R._stored_blocks(spark, sf), B_SHORT).select(*R.POINT10)


def q_clip_many_boxes_stored(spark, sf):
    out = PR.clip_many_boxes_blocks(R._stored_blocks(spark, sf), R._nation_boxes(spark, sf))
    return out.select("box_id", "x", "y", "z", "mortonCode")


def _near_boxes(spark, sf):
    """A box per nation, all in one corner of the cloud."""
    n = CD.table(spark, sf, "nation")
    low = {a: (F.col("n_nationkey") * step + start).cast("long") for a, step, start in (("x", 150, 17000), ("y", 90, 2000), ("z", 50, 0))}
    return n.select(F.col("n_nationkey").alias("box_id"), *[low[a].alias(f"{a}0") for a in "xyz"],
                    *[(low[a] + 900).alias(f"{a}1") for a in "xyz"])


def zone_mapped_store(spark, sf) -> tuple[str, str]:
    """Paths of a blocks store of several files and of its zone map."""
    store, zones = R.scratch_path(spark, "zoned-blocks"), R.scratch_path(spark, "zone-map")
    IO.write_blocks(R._blocks(spark, sf), store, num_partitions=STORE_FILES)
    PR.write_zone_map(spark, store, zones)
    return store, zones


def q_zone_map_clip(spark, sf):
    out = PR.clip_through_zones(spark, *zone_mapped_store(spark, sf), _near_boxes(spark, sf))
    return out.select("box_id", "x", "y", "z", "mortonCode")


def q_clouds_encode(spark, sf):
    """Every point in the cells of its own cloud (a cloud per line number)."""
    out = MC.encode_clouds(R._L(spark, sf), "intensity")
    return out.select(MC.CLOUD, "x", "y", "z", "mortonCode", "blockMortonCode")


def _stored_clouds(spark, sf):
    """(blocks of all clouds, their catalog)."""
    points = R._L(spark, sf)
    catalog = MC.cloud_extents(points, "intensity")
    path = R.scratch_path(spark, "clouds")
    MC.write_clouds_as_blocks(MC.encode_clouds(points, "intensity", catalog), path)
    return MC.read_cloud_blocks(spark, path), catalog


def q_clouds_clip(spark, sf):
    """A box per cloud, from a quarter to a half or three quarters of its own extent."""
    blocks, catalog = _stored_clouds(spark, sf)
    at = lambda a, share: (F.col(f"min{a}") + (F.col(f"max{a}") - F.col(f"min{a}")) * share)
    boxes = catalog.select(F.col(MC.CLOUD).alias("box_id"), MC.CLOUD, *[at(a, 0.25).alias(f"{a.lower()}0") for a in "XYZ"],
                           *[at(a, share).alias(f"{a.lower()}1") for a, share in zip("XYZ", (0.5, 0.75, 0.75))])
    return MC.clip_clouds(blocks, catalog, boxes).select("box_id", MC.CLOUD, "x", "y", "z", "mortonCode")


def q_clouds_clip_one(spark, sf):
    return MC.clip_cloud(*_stored_clouds(spark, sf), *CLOUD_BOX).select(MC.CLOUD, "x", "y", "z", "mortonCode", "red")


def q_octree_leaves(spark, sf):
    return OT.octree_leaves(R._coded(spark, sf), LEAF_CAP)


def q_octree_files(spark, sf):
    """Files of a store cut along octree leaves, as read back: code interval and points of each."""
    path = R.scratch_path(spark, "octree-blocks")
    OT.write_octree_store(R._coded(spark, sf), path, FILE_POINTS, LEAF_CAP)
    return OT.stored_files(spark, path)


def q_generations_compact(spark, sf):
    """The lineitem cloud streamed into generations of a store, compacted: one row per block."""
    src, root, ckpt = (R.scratch_path(spark, f"generations-{n}") for n in ("src", "root", "ckpt"))
    IO.write_points_text(R._L(spark, sf).repartition(6), src)
    stream = CD.flatten_loaded(SI.read_points_text_stream(spark, src, max_files_per_trigger=2))
    coded = SI.encode_stream(stream, R.EX.extent_values(R._L(spark, sf)))
    GN.start_generation_ingest(coded, root, ckpt, available_now=True).awaitTermination()
    GN.compact(spark, root)
    return R._block_summary(GN.read_generation(spark, root))


def q_stream_range_set(spark, sf):
    """The key ranges as a stream of files, inserted into a range set that is kept as state."""
    src, out, ckpt = (R.scratch_path(spark, f"range-set-{n}") for n in ("src", "out", "ckpt"))
    ranges = R._key_ranges(spark, sf)
    ranges.repartition(6).write.parquet(src)
    stream = spark.readStream.schema(ranges.schema).option("maxFilesPerTrigger", 2).parquet(src)
    RS.start_range_set(stream, ["l_returnflag"], out, ckpt, available_now=True).awaitTermination()
    return RS.read_range_set(spark, out, ["l_returnflag"])


def q_range_cut_many(spark, sf):
    """The merged key ranges without the part keys of the same flag."""
    pivots = CD.table(spark, sf, "lineitem").select("l_returnflag", F.col("l_partkey").alias("pivot"))
    return RG.subtract_pivots(R._key_ranges(spark, sf), pivots, groups=["l_returnflag"])


def q_st_periodic_box(spark, sf):
    return ST.st_periodic_filter(R._stored_events(spark, sf), *PERIODIC_BOX).select("id", "event_type", "lon", "lat", "t")


def q_sql_functions_clip(spark, sf):
    """The blocks of a box in plain SQL."""
    SQ.register(spark)
    view = f"blocks_{uuid.uuid4().hex[:12]}"
    R._stored_blocks(spark, sf).createOrReplaceTempView(view)
    (x0, y0, z0), (x1, y1, z1) = CL.block_cells(R.B1)
    return spark.sql(f"""SELECT blockMortonCode, part, size(points) AS n_points FROM {view}
        WHERE z_in_box(code => blockMortonCode, x0 => {x0}, y0 => {y0}, z0 => {z0}, x1 => {x1}, y1 => {y1}, z1 => {z1})""")


def q_sql_functions_codes(spark, sf):
    """Codes, cells, blocks and distances by the SQL functions."""
    SQ.register(spark)
    view = f"cells_{uuid.uuid4().hex[:12]}"
    R.EX.normalize_coords(R._L(spark, sf)).createOrReplaceTempView(view)
    return spark.sql(f"""SELECT mortonCode, z_axis(mortonCode, 0) AS cx, z_axis(code => mortonCode, dim => 1) AS cy,
        z_axis(mortonCode, 2) AS cz, z_block(mortonCode, 8) AS blockMortonCode, near
        FROM (SELECT z_encode(normX, normY, normZ) AS mortonCode, z_near(x, y, z, 50, 25, 5, 20) AS near FROM {view})""")


def _cells_where(box) -> str:
    return " AND ".join(f"norm{a} BETWEEN {lo} AND {hi}" for a, lo, hi in zip("XYZ", *box))


CLOUDS_CTE = f"""CE AS (SELECT intensity AS cloud_id, min(x) AS minX, min(y) AS minY, min(z) AS minZ, max(x) AS maxX,
  max(y) AS maxY, max(z) AS maxZ FROM L GROUP BY intensity),
CN AS (SELECT L.*, CE.cloud_id, CAST(round((x - minX) * 1000) AS BIGINT) AS normX,
  CAST(round((y - minY) * 1000) AS BIGINT) AS normY, CAST(round((z - minZ) * 1000) AS BIGINT) AS normZ
  FROM L JOIN CE ON L.intensity = CE.cloud_id),
CC AS (SELECT *, {R.s_enc('normX', 'normY', 'normZ')} AS mortonCode FROM CN)"""

LEAVES_CTE = f"""O AS (SELECT lv AS level, mortonCode >> (3 * lv) AS code, count(*) AS n FROM P, range(8, 22) t(lv) GROUP BY 1, 2),
LEAF AS (SELECT o.level, o.code, o.n, o.code * CAST(2 ** (3 * o.level) AS HUGEINT) AS lo FROM O o
  LEFT JOIN O p ON p.level = o.level + 1 AND p.code = o.code >> 3
  WHERE (o.n <= {LEAF_CAP} OR o.level = 8) AND (o.level = 21 OR p.n > {LEAF_CAP})),
LEAVES AS (SELECT level, code, lo, lo + CAST(2 ** (3 * level) AS HUGEINT) - 1 AS hi, n AS n_points FROM LEAF)"""


def _cloud_box_where(cloud, low, high) -> str:
    inside = " AND ".join(
        f"CAST(round((CAST({lo} AS DOUBLE) - min{a}) * 1000) AS BIGINT) <= norm{a} AND norm{a} <= "
        f"CAST(round((CAST({hi} AS DOUBLE) - min{a}) * 1000) AS BIGINT)" for a, lo, hi in zip("XYZ", low, high))
    return f"c.cloud_id = {cloud} AND {inside}"


def _periodic_where() -> str:
    (l0, l1), (b0, b1), (t0, t1) = PERIODIC_BOX
    return f"(lon >= {l0} OR lon <= {l1}) AND lat BETWEEN {b0} AND {b1} AND (t >= {t0} OR t <= {t1})"


QUERIES: dict[str, R.Query] = {
    "clip_short_box": q_clip_short_box,
    "clip_many_boxes_stored": q_clip_many_boxes_stored,
    "zone_map_clip": q_zone_map_clip,
    "clouds_encode": q_clouds_encode,
    "clouds_clip": q_clouds_clip,
    "clouds_clip_one": q_clouds_clip_one,
    "octree_leaves": q_octree_leaves,
    "octree_files": q_octree_files,
    "generations_compact": q_generations_compact,
    "stream_range_set": q_stream_range_set,
    "range_cut_many": q_range_cut_many,
    "st_periodic_box": q_st_periodic_box,
    "sql_functions_clip": q_sql_functions_clip,
    "sql_functions_codes": q_sql_functions_codes,
}

ORACLES: dict[str, str] = {
    "clip_short_box": R._with(R.BASE) + f"SELECT {R.S_POINT10} FROM P WHERE {_cells_where(B_SHORT)}",
    "clip_many_boxes_stored": R.ORACLES["clip_many_boxes"],
    "zone_map_clip": R._with(R.BASE) + """SELECT n_nationkey AS box_id, x, y, z, mortonCode FROM P JOIN nation ON """ + " AND ".join(
        f"norm{a} BETWEEN n_nationkey * {step} + {start} AND n_nationkey * {step} + {start} + 900"
        for a, step, start in (("X", 150, 17000), ("Y", 90, 2000), ("Z", 50, 0))),
    "clouds_encode": R._with(R.L_CTE, CLOUDS_CTE) + """SELECT CAST(cloud_id AS BIGINT) AS cloud_id, x, y, z, mortonCode,
  mortonCode >> 24 AS blockMortonCode FROM CC""",
    "clouds_clip": R._with(R.L_CTE, CLOUDS_CTE) + "SELECT CAST(c.cloud_id AS BIGINT) AS box_id, CAST(c.cloud_id AS BIGINT) AS cloud_id, "
    "x, y, z, mortonCode FROM CC c JOIN CE e ON c.cloud_id = e.cloud_id WHERE " + " AND ".join(
        f"norm{a} BETWEEN CAST(round((min{a} + (max{a} - min{a}) * CAST(0.25 AS DOUBLE) - min{a}) * 1000) AS BIGINT) "
        f"AND CAST(round((min{a} + (max{a} - min{a}) * CAST({share} AS DOUBLE) - min{a}) * 1000) AS BIGINT)"
        for a, share in zip("XYZ", (0.5, 0.75, 0.75))),
    "clouds_clip_one": R._with(R.L_CTE, CLOUDS_CTE) + "SELECT CAST(c.cloud_id AS BIGINT) AS cloud_id, x, y, z, mortonCode, red "
    f"FROM CC c JOIN CE e ON c.cloud_id = e.cloud_id WHERE {_cloud_box_where(*CLOUD_BOX)}",
    "octree_leaves": R._with(R.BASE, LEAVES_CTE) + """SELECT CAST(level AS INTEGER) AS level, code, CAST(lo AS BIGINT) AS lo,
  CAST(hi AS BIGINT) AS hi, n_points FROM LEAVES""",
    "octree_files": R._with(R.BASE, LEAVES_CTE, f"""F AS (SELECT lo, hi, floor(coalesce(sum(n_points) OVER (ORDER BY lo
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {FILE_POINTS}) AS f FROM LEAVES),
S AS (SELECT f, min(lo) AS lo, max(hi) AS hi FROM F GROUP BY f)""") + """SELECT min(mortonCode) AS lo, max(mortonCode) AS hi,
  count(*) AS n_points FROM P JOIN S ON mortonCode BETWEEN lo AND hi GROUP BY f""",
    "generations_compact": R.ORACLES["blocks_collect"],
    "stream_range_set": R.ORACLES["range_coalesce"],
    "range_cut_many": """WITH C AS (SELECT DISTINCT l_returnflag, unnest(range(l_orderkey, l_orderkey + l_linenumber)) AS c FROM lineitem),
K AS (SELECT l_returnflag, c FROM C EXCEPT SELECT l_returnflag, l_partkey FROM lineitem),
N AS (SELECT *, c - row_number() OVER (PARTITION BY l_returnflag ORDER BY c) AS island FROM K)
SELECT l_returnflag, min(c) AS lo, max(c) AS hi FROM N GROUP BY l_returnflag, island""",
    "st_periodic_box": R._with(R.V_CTE) + f"SELECT id, event_type, lon, lat, t FROM V WHERE {_periodic_where()}",
    "sql_functions_clip": R.ORACLES["sql_clip"],
    "sql_functions_codes": R._with(R.BASE) + """SELECT mortonCode, CAST(normX AS INTEGER) AS cx, CAST(normY AS INTEGER) AS cy,
  CAST(normZ AS INTEGER) AS cz, blockMortonCode,
  (x - 50) * (x - 50) + (y - 25) * (y - 25) + (z - 5) * (z - 5) <= 400 AS near FROM P""",
}
