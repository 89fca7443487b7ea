import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, dec, enc
from zpoints import registry as R
from zpoints.operators import neighbours as NB
from zpoints.operators import ranges as RG
from zpoints.sources import clouds as CD
from zpoints.sources import io as IO


def test_text_parse_strict_and_lenient(spark):
    lines = spark.createDataFrame([("1.5 2 3 7 1 2 3",), ("1 2 3 4 5 6 7 8",)], "value string")
    got = IO.parse_points_text(lines).collect()
    assert got[0].coordinates.x == 1.5 and got[0].intensity == 7 and got[1].blue == 7
    bad = spark.createDataFrame([("1 2 3 4 5 6",), ("a 2 3 4 5 6 7",)], "value string")
    with pytest.raises(Exception):
        IO.parse_points_text(bad).collect()
    lenient = IO.parse_points_text(bad, lenient=True).collect()
    assert lenient[0].blue is None and lenient[1].coordinates.x is None


def test_radius_join_equals_brute_force_and_salting(spark):
    pts = CD.embeddings_cloud(spark, SF_SMALL).cache()
    rows = pts.collect()
    want = sorted((a.id, b.id) for a in rows for b in rows
                  if (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) + (b.z - a.z) * (b.z - a.z)
                  <= 0.05 * 0.05)
    got = sorted(tuple(r) for r in NB.radius_join(pts, 0.05).collect())
    assert got == want
    salted = sorted(tuple(r) for r in NB.radius_join(pts, 0.05, hot_cell_rows=3).collect())
    assert salted == want


def test_cut_golden(spark):
    # (1, 9) as a range whose box contains pivot 5 in user space, and a single-code range
    df = spark.createDataFrame([(1, 9, 5, True), (7, 7, 7, True)], "lo long, hi long, pivot long, inb boolean")
    got = sorted((r.lo, r.cut_lo, r.cut_hi) for r in RG.cut_ranges(df, in_range="inb").collect())
    assert got == [(1, 1, 4), (1, 6, 9)]


def test_cut_divides_a_range_once(spark):
    """Short ranges at the top of the code space; the fold is in the plan once, and not bound to all 63 bits."""
    top = enc(1 << 20, 4, 1 << 20)
    ends = [(a, b) for a in (0, 1, 9) for b in (10, 27, 63) if all(x <= y for x, y in zip(dec(a), dec(b)))]
    rows = [(top + a, top + b, top + p) for a, b in ends for p in range(a, b + 1)]
    df = spark.createDataFrame([*rows, (None, 9, 5)], "lo long, hi long, pivot long")
    out = RG.cut_ranges(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence(") == 1 and "sequence(62" not in plan
    inside = lambda c, lo, hi: all(x <= y <= z for x, y, z in zip(dec(lo), dec(c), dec(hi)))
    want = [(None, 9, 5, 0, None, 0), (None, 9, 5, 1, 0, 9)]
    for lo, hi, p in rows:
        if p in (lo, hi) and inside(p, lo, hi):
            want.append((lo, hi, p, 0, *([hi] * 2 if p == lo else [lo] * 2)))
        elif inside(p, lo, hi):
            want += [(lo, hi, p, 0, lo, p - 1), (lo, hi, p, 1, p + 1, hi)]
        else:
            cells = [c for c in range(lo, hi + 1) if inside(c, lo, hi)]
            want += [(lo, hi, p, 0, lo, max([c for c in cells if c < p], default=0)),
                     (lo, hi, p, 1, min([c for c in cells if c > p], default=0), hi)]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_chunk_prune_exact(spark):
    chunks = spark.createDataFrame([(0, 0, 63), (1, 64, 127), (2, enc(3, 3, 3), enc(3, 3, 3) + 5)],
                                   "chunk_id int, lo long, hi long")
    boxes = spark.createDataFrame([(1, enc(1, 1, 1), enc(2, 2, 2))], "box_id int, zmin long, zmax long")
    got = sorted(r.chunk_id for r in RG.chunk_prune(chunks, boxes).collect())
    want = sorted(c for c, lo, hi in [(0, 0, 63), (1, 64, 127), (2, enc(3, 3, 3), enc(3, 3, 3) + 5)]
                  if any(lo <= enc(x, y, z) <= hi for x in (1, 2) for y in (1, 2) for z in (1, 2)))
    assert got == want


def test_global_coalesce_matches_per_group_and_handles_skew(spark):
    import random
    random.seed(5)
    rows = [("hot", lo, lo + random.randint(0, 3)) for lo in (random.randint(0, 3000) for _ in range(3000))]
    rows += [("hot", 10, 12)] * 500 + [("cold", 1, 2), ("cold", 3, 4), ("cold", 9, 9), ("x", 2, 3), ("x", 5, 6),
                                        ("x", 1, 4)]
    df = spark.createDataFrame(rows, "g string, lo long, hi long")
    got = sorted(tuple(r) for r in RG.coalesce_ranges(df, groups=["g"], num_partitions=7).collect())
    want = sorted(tuple(r) for r in RG.coalesce_ranges_per_group(df, groups=["g"]).collect())
    assert got == want
    assert ("cold", 1, 4) in got and ("cold", 9, 9) in got and ("x", 1, 6) in got


def test_st_ranges_cover_the_events(spark):
    from zpoints.functions import spacetime as ST
    ev = ST.st_index(CD.events_cloud(spark, SF_SMALL))
    box = ((-100.0, 60.0), (-30.0, 45.0), (86400, 4 * 86400))
    ranges = [(r.lo, r.hi) for r in ST.st_ranges(spark, *box).collect()]
    inside = ev.filter(F.col("lon").between(*box[0]) & F.col("lat").between(*box[1])
                       & F.col("t").between(*box[2])).collect()
    assert inside
    for r in inside:
        assert any(lo <= r.stCode <= hi for lo, hi in ranges)


def test_coarse_partition_pruning_and_export(spark):
    from zpoints.operators import clip as CL
    from zpoints.operators import extent as EX
    from zpoints.operators import blocks as BL
    coded = EX.encode_points(CD.lineitem_cloud(spark, SF_SMALL))
    path = R.scratch_path(spark, "test-coarse")
    IO.write_points_partitioned(coded, path)
    back = IO.read_points_partitioned(spark, path)
    bcells = CL.block_cells(R.B1)
    ranges = CL.frontier_ranges(bcells)
    sel = back.filter(IO.coarse_filter_for(ranges)).filter(CL.box_predicate("blockMortonCode", bcells))
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*coarse#", plan)
    kept = back.filter(IO.coarse_filter_for(ranges)).select("coarse").distinct().count()
    assert kept < back.select("coarse").distinct().count()  # directories that no range meets are pruned
    want = CL.clip_blocks_cells(coded, bcells, pushdown=False)
    assert sorted(r.mortonCode for r in sel.collect()) == sorted(r.mortonCode for r in want.collect())
    out = R.scratch_path(spark, "test-export")
    stored = BL.collect_blocks(coded)
    IO.write_export(CL.clip_blocks_cells(stored, bcells, pushdown=False), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == sel.count() and all(len(l.split(" ")) == 3 for l in lines)


def test_zranges_codes_and_validity(spark):
    from zpoints.plans import cover as CV
    boxes = spark.createDataFrame([(1, enc(11, 8, 0), enc(17, 12, 4))], "box_id int, zmin long, zmax long")
    rs = CV.zranges_codes(boxes).collect()
    assert len(rs) == 50 and sum(r.hi - r.lo + 1 for r in rs) == 175
    bad = spark.createDataFrame([(1, 10, 5)], "box_id int, zmin long, zmax long")
    with pytest.raises(Exception):
        CV.zranges_codes(bad).collect()


def test_nested_shapes(spark):
    from zpoints.operators import extent as EX
    from zpoints.operators import stats as SS
    pts = CD.lineitem_cloud(spark, SF_SMALL)
    loaded = CD.nest_loaded(pts)
    assert loaded.schema["coordinates"].dataType.fieldNames() == ["x", "y", "z"]
    assert CD.flatten_loaded(loaded).count() == pts.count()
    cat = SS.nest_catalog(SS.cloud_catalog(EX.encode_points(pts), "intensity", "lineitem"))
    assert cat.schema.fieldNames() == ["id", "name", "resolution", "extent", "offsets", "scaleFactors"]
    ext = EX.extent_literal(EX.extent_values(pts), spark)
    assert ext.count() == 1


def test_range_merge_rejects_bad_ranges_and_takes_the_top_code(spark):
    top = (1 << 63) - 1
    df = spark.createDataFrame([(1, 5, 20), (1, top - 3, top), (1, top - 9, top - 4), (2, -top - 1, -top), (2, -top + 1, 0)],
                               "box_id int, lo long, hi long")
    got = sorted(tuple(r) for r in RG.coalesce_ranges(df, num_partitions=4).collect())
    assert got == [(1, 5, 20), (1, top - 9, top), (2, -top - 1, 0)]
    for bad in [(1, 9, 3), (1, None, 3), (1, 3, None)]:
        df = spark.createDataFrame([(1, 1, 5), bad, (1, 20, 30)], "box_id int, lo long, hi long")
        with pytest.raises(Exception, match="range ends"):
            RG.coalesce_ranges(df).collect()


def test_one_range_over_all_partitions(spark):
    rows = [("a", i * 10, i * 10 + 3) for i in range(400)] + [("a", 55, 3500), ("b", 0, 1)]
    df = spark.createDataFrame(rows, "g string, lo long, hi long")
    got = sorted(tuple(r) for r in RG.coalesce_ranges(df, groups=["g"], num_partitions=9).collect())
    want = sorted(tuple(r) for r in RG.coalesce_ranges_per_group(df, groups=["g"]).collect())
    assert got == want


def test_strict_parse_does_not_need_ansi_mode(spark):
    bad = spark.createDataFrame([("a 2 3 4 5 6 7",)], "value string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="no valid x"):
            IO.parse_points_text(bad).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_hot_cells_keep_tasks_bounded(spark):
    pts = spark.range(600).select(F.col("id"), (F.col("id") % 7 * 1e-4).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    joined = NB.radius_join(pts, 0.05, hot_cell_rows=40)
    assert joined.count() == 600 * 600


def test_wide_space_time_box_loses_nothing(spark):
    from zpoints.functions import spacetime as ST
    rows = [(i, -180.0 + i * 3.6, -90.0 + (i * 7 % 100) * 1.8, i * 6000) for i in range(101)]
    ev = spark.createDataFrame(rows, "id long, lon double, lat double, t long")
    path = R.scratch_path(spark, "test-events")
    ST.write_events(ev, path)
    for box in (((-200.0, 60.0), (-90.0, -10.0), (0, 10**6)), ((-170.0, 200.0), (-95.0, 95.0), (-5, 300000))):
        got = ST.st_box_filter(spark.read.parquet(path), *box)
        assert got.count() == sum(all(a <= v <= b for v, (a, b) in zip(r[1:], box)) for r in rows)
    with pytest.raises(Exception, match="domain"):
        ST.st_index(spark.createDataFrame([(1, 190.0, 0.0, 0)], "id long, lon double, lat double, t long")).collect()
