"""Box -> Z-order range cover, computed as a Spark job over a table of boxes.

A box (inclusive integer cells per axis) is covered by octree octants: start
at the octant of the codes' common prefix; an octant inside the box is
emitted whole; an octant that only overlaps is split into its 8 children,
until a depth limit below the prefix (7, 6 or 5 levels for fewer than 30,
fewer than 40, or more shared bits), where it is emitted whole (so the cover
may be larger than the box, never smaller). The emitted octants are merged
into sorted, disjoint, non-adjacent ranges.

Instead of a recursion on the driver, the octree walk is a level-by-level
expansion: every level explodes the octants that must be split into 8 child
rows, and carries finished rows along. Seven levels are enough for any depth
limit, so the plan is a fixed chain of seven Generate steps over however
many boxes the table holds. Per box the output is bounded by the depth cap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zpoints.functions.zcode import (
    _lit, _shl, _shru, common_prefix, decode_axis, depth_limit, morton_code, with_decoded,
)
from zpoints.schema import LONG_MAX, MAX_DIM, TOTAL_BITS

MAX_LEVELS = 7
CELL_COLS = ["x0", "y0", "z0", "x1", "y1", "z1"]

EMIT, DESCEND, DROP = 1, 2, 0


def _ones(offset: Column) -> Column:
    """2**offset - 1 without overflow for offset in [0, 63]."""
    return _shru(_lit(LONG_MAX), F.lit(TOTAL_BITS) - offset)


def _status_sql(ox: str, oy: str, oz: str, side: str, level: str, offset: str) -> str:
    """Classify an octant against its box: EMIT (1) when inside, DESCEND (2)
    when overlapping above the depth limit, EMIT at the limit, DROP (0) when
    disjoint. An octant carries its low corner cell and its side in cells,
    so no code is decoded per level. SQL text: one parse per level."""
    lo = [ox, oy, oz]
    inside = " AND ".join(f"({v}) >= {a}0 AND ({v}) + ({side}) - 1 <= {a}1" for v, a in zip(lo, "xyz"))
    overlap = " AND ".join(f"greatest({v}, {a}0) <= least(({v}) + ({side}) - 1, {a}1)" for v, a in zip(lo, "xyz"))
    return (f"CASE WHEN {inside} THEN {EMIT} "
            f"WHEN {overlap} AND ({level}) < lim AND ({offset}) > 0 THEN {DESCEND} "
            f"WHEN {overlap} THEN {EMIT} ELSE {DROP} END")


def validate_cells(boxes: DataFrame) -> DataFrame:
    """Reject boxes inverted on any axis (min > max) with a clear error."""
    bad = reduce(lambda a, b: a | b,
                 [F.col(CELL_COLS[d]) > F.col(CELL_COLS[d + 3]) for d in range(MAX_DIM)])
    return boxes.withColumn(
        "__ok", F.when(bad, F.raise_error(F.concat(
            F.lit("inverted box (min > max on an axis), box_id="), F.col("box_id").cast("string"))))
        .otherwise(F.lit(True))
    ).filter(F.col("__ok")).drop("__ok")


def cover_octants(boxes: DataFrame, levels: int = MAX_LEVELS) -> DataFrame:
    """(box_id, x0, y0, z0, x1, y1, z1) cells -> emitted octants
    (box_id, lo, hi, level), not yet merged."""
    b = validate_cells(boxes.select("box_id", *[F.col(c).cast("long").alias(c) for c in CELL_COLS]))
    # a box is one short row but may become 10^5 octants: spread the boxes before they grow
    # (a given number of partitions is not coalesced by their size)
    b = b.repartition(int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "box_id")
    zmin = morton_code("x0", "y0", "z0")
    zmax = morton_code("x1", "y1", "z1")
    b = b.withColumn("__cp", common_prefix(zmin, zmax))
    df = b.select(
        "box_id", *CELL_COLS,
        depth_limit(F.col("__cp.bits")).alias("lim"),
        F.col("__cp.prefix").alias("omin"),
        (F.lit(TOTAL_BITS) - F.col("__cp.bits")).alias("offset"),
        F.lit(0).alias("level"),
    )
    # the root octant: its low corner is the decoded prefix, its side 2**(offset/3)
    df = with_decoded(df, "omin", out=("ox", "oy", "oz"))
    df = df.selectExpr("*", "shiftleft(1L, CAST(offset / 3 AS INT)) AS side")
    df = df.selectExpr("*", _status_sql("ox", "oy", "oz", "side", "level", "offset") + " AS status")
    keep = ["box_id", *CELL_COLS, "lim"]
    state = ["omin", "offset", "level", "ox", "oy", "oz", "side", "status"]
    step = {
        "omin": "omin | shiftleft(CAST(child AS BIGINT), offset - 3)",
        "offset": "offset - 3",
        "level": "level + 1",
        "ox": "ox + (child & 1) * shiftright(side, 1)",
        "oy": "oy + (shiftright(child, 1) & 1) * shiftright(side, 1)",
        "oz": "oz + (shiftright(child, 2) & 1) * shiftright(side, 1)",
        "side": "shiftright(side, 1)",
    }
    step["status"] = _status_sql(step["ox"], step["oy"], step["oz"], step["side"], step["level"], step["offset"])
    for _ in range(levels):
        # one Generate and one projection per level: octants to split become
        # 8 children, finished ones a single -1 marker, dropped ones nothing
        df = df.selectExpr(*keep, *state, f"explode(CASE WHEN status = {DESCEND} THEN sequence(0, 7) "
                           f"WHEN status = {EMIT} THEN array(-1) ELSE CAST(array() AS array<int>) END) AS child")
        df = df.selectExpr(*keep, *[f"CASE WHEN child >= 0 THEN {step[k]} ELSE {k} END AS {k}" for k in state])
    # keep the emitted octants with one more Generate rather than a Filter: a
    # filter on ``status`` would be pushed down and have the status, corner
    # and prefix expressions inlined into it (with no level in between, as
    # for a single-cell box, that blows up the optimizer)
    df = df.selectExpr(*keep, *state, f"explode(CASE WHEN status = {EMIT} THEN array(1) "
                                      f"ELSE CAST(array() AS array<int>) END) AS __keep")
    return df.select("box_id", F.col("omin").alias("lo"),
                     F.col("omin").bitwiseOR(_ones(F.col("offset"))).alias("hi"), "level")


def coalesce_ranges(ranges: DataFrame, groups=("box_id",), lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Merge overlapping or adjacent inclusive ranges per group (gaps and
    islands): a range opens a new island when it starts more than one past
    the largest end seen before it in (lo, hi) order."""
    groups = list(groups)
    w = Window.partitionBy(*groups).orderBy(F.col(lo), F.col(hi))
    prev_end = F.max(F.col(hi)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(prev_end.isNull() | (F.col(lo) > F.try_add(prev_end, F.lit(1).cast("long"))), 1).otherwise(0)
    flagged = ranges.withColumn("__start", starts)
    islands = flagged.withColumn(
        "__island", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy(*groups, "__island")
                   .agg(F.min(lo).alias(lo), F.max(hi).alias(hi))
                   .drop("__island"))


def zranges(boxes: DataFrame, levels: int = MAX_LEVELS) -> DataFrame:
    """(box_id, x0, y0, z0, x1, y1, z1) -> merged cover (box_id, lo, hi).
    ``levels`` may be lowered when every box is known to need fewer."""
    return coalesce_ranges(cover_octants(boxes, levels).drop("level"))


def zranges_codes(boxes: DataFrame) -> DataFrame:
    """(box_id, zmin, zmax) codes -> merged cover; the box is the per-axis
    span of the two decoded codes. Requires zmin <= zmax."""
    checked = boxes.withColumn("__ok", F.when(
        F.col("zmin") > F.col("zmax"),
        F.raise_error(F.lit("range min must not exceed max"))).otherwise(F.lit(True)))
    cells = checked.select(
        "box_id",
        *[decode_axis("zmin", d).alias(CELL_COLS[d]) for d in range(MAX_DIM)],
        *[decode_axis("zmax", d).alias(CELL_COLS[d + 3]) for d in range(MAX_DIM)],
    )
    return zranges(cells)


def box_table(spark, boxes) -> DataFrame:
    """Boxes given as [(box_id, x0, y0, z0, x1, y1, z1), ...] cells -> table.
    For small literal box lists only (tests, one-off clips)."""
    return spark.createDataFrame(
        [tuple(int(v) for v in b) for b in boxes],
        "box_id int, x0 long, y0 long, z0 long, x1 long, y1 long, z1 long")
