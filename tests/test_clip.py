import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from zpoints import registry as R
from zpoints.operators import blocks as BL
from zpoints.operators import clip as CL
from zpoints.operators import extent as EX
from zpoints.sources import clouds as CD
from zpoints.sources import io as IO


@pytest.fixture(scope="module")
def coded(spark):
    return EX.encode_points(CD.lineitem_cloud(spark, SF_SMALL), keep_cells=True).cache()


@pytest.fixture(scope="module")
def stored(spark, coded):
    path = R.scratch_path(spark, "test-blocks")
    IO.write_blocks(BL.collect_blocks(coded.drop("normX", "normY", "normZ")), path)
    return IO.read_blocks(spark, path)


def _exact(coded, cells):
    (x0, y0, z0), (x1, y1, z1) = cells
    return coded.filter(F.col("normX").between(x0, x1) & F.col("normY").between(y0, y1)
                        & F.col("normZ").between(z0, z1))


def test_clip_points_equals_brute_force(coded, stored):
    got = sorted(r.mortonCode for r in CL.clip_points(stored, R.B1).collect())
    want = sorted(r.mortonCode for r in _exact(coded, R.B1).collect())
    assert got == want and len(got) == 28


def test_clip_blocks_is_superset_and_pushed_down(coded, stored):
    blocks = CL.clip_blocks_cells(stored, CL.block_cells(R.B1))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[(IsNotNull\(blockMortonCode\), )?Or\(", plan)
    chosen = {r.blockMortonCode for r in blocks.collect()}
    exact_blocks = {r.blockMortonCode for r in _exact(coded, R.B1).collect()}
    assert exact_blocks <= chosen


def test_in_plan_clip_uses_range_join(coded):
    got = CL.clip_coded_points(coded.drop("normX", "normY", "normZ"), R.B1)
    assert got.count() == 28


def test_box_outside_is_empty(stored):
    assert CL.clip(stored, (0.0, 0.0, 0.0), (-50.0, -50.0, -50.0), (-40.0, -40.0, -40.0)).count() == 0


def test_inverted_box_raises():
    with pytest.raises(ValueError):
        CL.box_to_cells((0, 0, 0), (5, 5, 5), (4, 6, 6))


TOP = (1 << 21) - 1


@pytest.mark.parametrize("short", [(e,) * n + (0,) * (3 - n) for e in (1, 100, 1000, 1 << 14) for n in (1, 2, 3)])
def test_ranges_of_boxes_short_of_an_aligned_size(short):
    for cells in (((0, 0, 0), tuple(TOP - e for e in short)), (short, (TOP,) * 3), ((0, 0, 0), tuple(4095 - min(e, 1000) for e in short))):
        start = time.perf_counter()
        ranges = CL.frontier_ranges(cells)
        assert time.perf_counter() - start < 0.2  # about 6 ms where nothing else runs
        assert len(ranges) <= CL.MAX_OR_TERMS
        volume = np.prod([float(h - l + 1) for l, h in zip(*cells)])
        assert volume <= sum(h - l + 1 for l, h in ranges) <= 2 * volume


def test_ranges_hold_few_codes_outside_the_box():
    for box, most in ((R.B1, 1.95), (R.B_LARGE, 1.94)):
        lo, hi = CL.block_cells(box)
        volume = np.prod([float(h - l + 1) for l, h in zip(lo, hi)])
        assert sum(b - a + 1 for a, b in CL.frontier_ranges((lo, hi))) <= most * volume
    assert CL.frontier_ranges(((0, 0, 0), (7, 7, 7))) == [(0, 511)]
    assert CL.frontier_ranges(((1, 2, 3), (1, 2, 3))) == [(53, 53)]


def test_compat_truncation_golden():
    cells = CL.box_to_cells((4.025, -15.3, -1.75), (7.0, -13.0, -1.5), (8.5, -12.0, -0.5), compat=True)
    assert cells == ((2974, 2300, 250), (4475, 3300, 1250))
    b = CL.block_cells(cells)
    assert b == ((11, 8, 0), (17, 12, 4))


def test_many_boxes_equals_brute_force(spark, coded):
    boxes = spark.createDataFrame([(1, 0, 0, 0, 30000, 20000, 5000), (2, 10000, 5000, 1000, 60000, 40000, 9000)],
                                  "box_id int, x0 long, y0 long, z0 long, x1 long, y1 long, z1 long")
    got = sorted((r.box_id, r.mortonCode) for r in CL.clip_many_boxes(coded.drop("normX", "normY", "normZ"), boxes)
                 .select("box_id", "mortonCode").collect())
    want = []
    for bid, x0, y0, z0, x1, y1, z1 in [(1, 0, 0, 0, 30000, 20000, 5000), (2, 10000, 5000, 1000, 60000, 40000, 9000)]:
        want += [(bid, r.mortonCode) for r in _exact(coded, ((x0, y0, z0), (x1, y1, z1))).collect()]
    assert got == sorted(want)


def test_range_join_with_no_ranges(spark, coded):
    empty = spark.createDataFrame([], "lo long, hi long, box_id int")
    out = CL.range_join(coded, empty, "blockMortonCode")
    assert out.count() == 0 and {"lo", "hi", "box_id"} <= set(out.columns)


def test_high_edge_on_block_boundary_rounding_vs_truncation():
    # a point at offset 4.6077 rounds to cell 4608; a box edge at 4.6079
    # rounds to 4608 too (kept), while truncation would give 4607 (missed)
    rounded = CL.box_to_cells((0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.6079, 1.0, 1.0))
    truncated = CL.box_to_cells((0.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.6079, 1.0, 1.0), compat=True)
    point_cell = round(4.6077 * 1000)
    assert rounded[1][0] >= point_cell > truncated[1][0]
