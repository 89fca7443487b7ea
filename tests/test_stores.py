"""Runtime filters, zone maps, many clouds, octree files, range sets as state, pivots, periodic boxes and SQL functions."""
import os
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, dec, enc
from zpoints import registry as R
from zpoints import registry_stores as S
from zpoints.functions import spacetime as ST
from zpoints.functions import sqlfuncs as SQ
from zpoints.operators import clip as CL
from zpoints.operators import manyclouds as MC
from zpoints.operators import neighbours as NB
from zpoints.operators import octree as OT
from zpoints.operators import prune as PR
from zpoints.operators import ranges as RG
from zpoints.sources import generations as GN
from zpoints.sources import io as IO
from zpoints.streaming import rangeset as RS

BOX_COLUMNS = "box_id int, x0 long, y0 long, z0 long, x1 long, y1 long, z1 long"


@pytest.fixture(scope="module")
def coded(spark):
    return R._coded(spark, SF_SMALL).cache()


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------------------
# Coarse ranges and zone maps
# ---------------------------------------------------------------------------

@pytest.mark.parametrize("most", [1, 2, 5, 32])
def test_coarse_ranges_keep_the_widest_gaps(spark, most):
    rng = random.Random(most)
    rows = [(lo, lo + rng.randrange(40)) for lo in (rng.randrange(100_000) for _ in range(300))] + [(5, 5)] * 4
    got = PR.coarse_ranges(spark.createDataFrame(rows, "lo long, hi long").repartition(5), most)
    islands = CL.merged(rows)
    assert len(got) == min(most, len(islands)) and got[0][0] == islands[0][0] and got[-1][1] == islands[-1][1]
    assert all(any(a <= lo and hi <= b for a, b in got) for lo, hi in rows)
    gaps = sorted((b[0] - a[1] for a, b in zip(islands, islands[1:])), reverse=True)
    assert sorted((b[0] - a[1] for a, b in zip(got, got[1:])), reverse=True) == gaps[:most - 1]


def test_coarse_ranges_of_no_boxes(spark, coded):
    empty = spark.createDataFrame([], BOX_COLUMNS)
    assert PR.coarse_ranges(spark.createDataFrame([], "lo long, hi long")) == []
    path = R.scratch_path(spark, "test-none")
    IO.write_points_as_blocks(coded, path)
    assert PR.clip_many_boxes_blocks(IO.read_blocks(spark, path), empty).count() == 0


def test_many_boxes_over_a_stored_table_are_pushed_down(spark):
    df = S.q_clip_many_boxes_stored(spark, SF_SMALL)
    assert re.search(r"PushedFilters: \[(IsNotNull\(blockMortonCode\), )?Or\(", _plan(df))
    plain = R.q_clip_many_boxes(spark, SF_SMALL)
    key = ["box_id", "mortonCode", "x", "y", "z"]
    assert sorted(map(tuple, df.select(key).collect())) == sorted(map(tuple, plain.select(key).collect()))


def test_zone_map_opens_fewer_files(spark):
    store, zones = S.zone_mapped_store(spark, SF_SMALL)
    boxes = S._near_boxes(spark, SF_SMALL)
    every = IO.read_blocks(spark, store)
    pruned = PR.read_through_zones(spark, store, zones, boxes)
    assert len(every.inputFiles()) == S.STORE_FILES and 0 < len(pruned.inputFiles()) < S.STORE_FILES
    key = ["box_id", "mortonCode", "x", "y", "z"]
    got = sorted(map(tuple, PR.clip_through_zones(spark, store, zones, boxes).select(key).collect()))
    assert got == sorted(map(tuple, PR.clip_many_boxes_blocks(every, boxes).select(key).collect())) and got
    far = spark.createDataFrame([(1, 2_000_000, 2_000_000, 2_000_000, 2_000_100, 2_000_100, 2_000_100)], BOX_COLUMNS)
    assert PR.clip_through_zones(spark, store, zones, far).count() == 0


def test_zone_map_has_every_row_and_must_cover_the_store(spark, coded):
    store, zones = (R.scratch_path(spark, n) for n in ("test-zoned", "test-zones"))
    IO.write_points_as_blocks(coded, store)
    PR.write_zone_map(spark, store, zones, zone_rows=50)
    z = PR.read_zone_map(spark, zones)
    assert z.agg(F.sum("rows")).first()[0] == IO.read_blocks(spark, store).count()
    assert z.agg(F.max("rows")).first()[0] <= 50 and z.select("file", "zone").distinct().count() == z.count()
    boxes = S._near_boxes(spark, SF_SMALL)
    PR.read_through_zones(spark, store, zones, boxes).count()
    IO.write_points_as_blocks(coded.limit(10), store, mode="append")
    with pytest.raises(ValueError, match="does not cover"):
        PR.read_through_zones(spark, store, zones, boxes)


# ---------------------------------------------------------------------------
# Many clouds
# ---------------------------------------------------------------------------

POINTS = "cloud int, x double, y double, z double, intensity int, classification byte, red short, green short, blue short"


def _points(spark, rows):
    return spark.createDataFrame([(c, *p, 0, 0, 0, 0, 0) for c, p in rows], POINTS)


def test_clouds_are_coded_in_their_own_extents(spark):
    rng = random.Random(4)
    rows = [(c, tuple(100.0 * c + rng.random() * 5 for _ in range(3))) for c in range(5) for _ in range(40)]
    out = MC.encode_clouds(_points(spark, rows), "cloud", keep_cells=True).collect()
    low = {c: [min(p[d] for k, p in rows if k == c) for d in range(3)] for c in range(5)}
    assert len(out) == len(rows)
    for r in out:
        want = [round((v - m) * 1000) for v, m in zip((r.x, r.y, r.z), low[r.cloud_id])]
        assert (r.normX, r.normY, r.normZ) == dec(r.mortonCode) and all(abs(a - b) <= 1 for a, b in zip(want, dec(r.mortonCode)))


def test_unknown_clouds_wide_clouds_and_outliers_raise(spark):
    rows = [(1, (0.0, 0.0, 0.0)), (1, (1.0, 1.0, 1.0)), (2, (0.0, 0.0, 0.0))]
    points = _points(spark, rows)
    known = MC.cloud_extents(points.where("cloud = 1"), "cloud")
    for bad, message in ((points, "no extent for cloud 2"), (_points(spark, [(None, (0.0, 0.0, 0.0))]), "no extent for cloud null"),
                         (_points(spark, [(1, (-1.0, 0.0, 0.0))]), "outside the 21-bit cell space of cloud 1")):
        with pytest.raises(Exception, match=message):
            MC.encode_clouds(bad, "cloud", known).collect()
    wide = _points(spark, [(7, (0.0, 0.0, 0.0)), (7, (2098.0, 0.0, 0.0))])
    with pytest.raises(Exception, match="cloud 7 spans more cells"):
        MC.encode_clouds(wide, "cloud").collect()
    assert MC.encode_clouds(wide, "cloud", precision=0.01).count() == 2
    with pytest.raises(ValueError):
        MC.clip_cloud(spark.createDataFrame([], MC.CLOUD_BLOCKS), known, 9, (0, 0, 0), (1, 1, 1))


def test_clip_of_one_cloud_is_pushed_down(spark):
    blocks, catalog = S._stored_clouds(spark, SF_SMALL)
    df = MC.clip_cloud(blocks, catalog, *S.CLOUD_BOX)
    plan = _plan(df)
    assert "EqualTo(cloud_id,3)" in plan and "Or(" in plan and "Exchange" not in plan
    assert {r.cloud_id for r in df.select("cloud_id").distinct().collect()} == {3}
    assert MC.clip_cloud(blocks, catalog, 3, (-900.0, 0.0, 0.0), (-800.0, 1.0, 1.0)).count() == 0


def test_boxes_meet_their_own_cloud_only(spark):
    """Two clouds with the same codes, a box for one of them, one box outside and one inverted."""
    rows = [(c, (base + i * 0.1, base + i * 0.1, base)) for c, base in ((1, 0.0), (2, 50.0)) for i in range(30)]
    points = _points(spark, rows)
    catalog = MC.cloud_extents(points, "cloud")
    path = R.scratch_path(spark, "test-two-clouds")
    MC.write_clouds_as_blocks(MC.encode_clouds(points, "cloud", catalog), path, max_points_per_row=4)
    blocks = MC.read_cloud_blocks(spark, path)
    columns = "box_id int, cloud_id int, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double"
    boxes = spark.createDataFrame([(5, 2, 50.5, 50.5, 50.0, 51.0, 51.0, 50.0), (6, 1, -9.0, -9.0, -9.0, -8.0, -8.0, -8.0)], columns)
    got = MC.clip_clouds(blocks, catalog, boxes).collect()
    assert {(r.box_id, r.cloud_id) for r in got} == {(5, 2)}
    assert sorted(round(r.x, 3) for r in got) == [50.5, 50.6, 50.7, 50.8, 50.9, 51.0]
    for bad in ((7, 1, 1.0, 0.0, 0.0, 0.5, 1.0, 1.0), (7, 3, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0)):
        with pytest.raises(Exception, match="inverted box|without an extent"):
            MC.clip_clouds(blocks, catalog, spark.createDataFrame([bad], columns)).collect()


# ---------------------------------------------------------------------------
# Octree
# ---------------------------------------------------------------------------

def _plain_leaves(codes, cap, floor):
    out = []

    def walk(level, code, inside):
        if not inside:
            return
        if len(inside) <= cap or level == floor:
            out.append((level, code, len(inside)))
            return
        for child in range(code * 8, code * 8 + 8):
            walk(level - 1, child, [c for c in inside if c >> (3 * (level - 1)) == child])

    walk(21, 0, codes)
    return sorted(out)


@pytest.mark.parametrize("cap,floor", [(1, 0), (7, 3), (50, 8), (10_000, 8)])
def test_octree_leaves_of_a_skewed_cloud(spark, cap, floor):
    rng = random.Random(cap)
    codes = [enc(*(rng.randrange(1 << 21) for _ in range(3))) for _ in range(150)]
    codes += [enc(*(1000 + rng.randrange(40) for _ in range(3))) for _ in range(500)] + [enc(5, 6, 7)] * 60
    df = spark.createDataFrame([(c,) for c in codes] + [(None,)], "mortonCode long").repartition(4)
    got = OT.octree_leaves(df, cap, floor).collect()
    assert sorted((r.level, r.code, r.n_points) for r in got) == _plain_leaves(codes, cap, floor)
    spans = sorted((r.lo, r.hi) for r in got)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and all(lo <= hi for lo, hi in spans)
    assert OT.octree_leaves(df.where("false"), cap, floor).count() == 0


def test_octree_files_are_near_equal_and_follow_octants(spark):
    """Half of all points in a millionth of the space."""
    rng = random.Random(9)
    cells = [tuple(rng.randrange(1 << 19) for _ in range(3)) for _ in range(3000)]
    cells += [tuple(4096 + rng.randrange(2048) for _ in range(3)) for _ in range(3000)]
    rows = [(float(x), float(y), float(z), enc(x, y, z), enc(x, y, z) >> 24, 0, 0, 0, 0, 0) for x, y, z in cells]
    df = spark.createDataFrame(rows, "x double, y double, z double, mortonCode long, blockMortonCode long, intensity int, "
                                     "classification byte, red short, green short, blue short").repartition(6)
    path, target, cap = R.scratch_path(spark, "test-octree"), 600, 60
    files = OT.write_octree_store(df, path, target, cap, floor=4).orderBy("lo").collect()
    stored = sorted(OT.stored_files(spark, path).collect(), key=lambda r: r.lo)
    assert [r.n_points for r in files] == [r.n_points for r in stored] and len(IO.read_blocks(spark, path).inputFiles()) == len(files)
    assert all(f.lo <= s.lo and s.hi <= f.hi for f, s in zip(files, stored))
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))
    assert all(target - cap <= r.n_points <= target + cap for r in files[:-1]) and sum(r.n_points for r in files) == 6000
    back = IO.read_blocks(spark, path).select("blockMortonCode", F.inline("points")).select("mortonCode", "coordinates.x")
    assert sorted(map(tuple, back.collect())) == sorted((r[3], r[0]) for r in rows)


def test_octree_store_writes_many_files_a_task(spark, coded):
    path = R.scratch_path(spark, "test-octree-tasks")
    files = OT.write_octree_store(coded, path, 20, 4)
    names = IO.read_blocks(spark, path).inputFiles()
    assert len(names) == files.count() > 100
    tasks = {re.search(r"part-(\d+)-", n).group(1) for n in names}
    assert len(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert IO.read_blocks(spark, path).columns == ["blockMortonCode", "part", "points"]
    assert _points_of(IO.read_blocks(spark, path)) == sorted(map(tuple, coded.select("mortonCode", "x", "red").collect()))
    assert OT.stored_files(spark, path).count() == len(names)


def test_octree_points_are_shuffled_once(spark, coded, monkeypatch):
    """However many files there are: what is written has one exchange and no join that shuffles the points."""
    plans, kept = {}, type(coded).sortWithinPartitions
    monkeypatch.setattr(type(coded), "sortWithinPartitions", lambda df, *cols: plans.update({cols[0]: _plan(df)}) or kept(df, *cols))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)  # as if the files were many
    try:
        OT.write_octree_store(coded, R.scratch_path(spark, "test-octree-once"), 20, 4)
    finally:
        spark.conf.set(name, before)
    plan = plans["file"].split("Initial Plan")[0]
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 1 and "SortMergeJoin" not in plan


def test_octree_store_splits_hot_blocks(spark, coded):
    path = R.scratch_path(spark, "test-octree-hot")
    files = OT.write_octree_store(coded.union(coded).union(coded), path, 300, 40, max_points_per_row=7)
    rows = IO.read_blocks(spark, path)
    assert rows.where("size(points) > 7").isEmpty() and not rows.where("part > 0").isEmpty() and files.count() > 1
    assert _points_of(rows) == sorted(3 * [tuple(r) for r in coded.select("mortonCode", "x", "red").collect()])


# ---------------------------------------------------------------------------
# Generations
# ---------------------------------------------------------------------------

def _points_of(blocks):
    rows = blocks.select(F.inline("points")).select("mortonCode", "coordinates.x", "red").collect()
    return sorted(map(tuple, rows))


def test_compaction_of_generations(spark, coded):
    root = R.scratch_path(spark, "test-generations")
    low, rest = coded.where("x < 20"), coded.where("x >= 20")
    far = (1 << 39) - 1
    assert GN.append_points(spark, root, low) == 1
    assert GN.append_points(spark, root, rest.where("intensity < 4")) == 2
    assert GN.append_points(spark, root, rest.where("intensity >= 4")) == 3
    apart = coded.limit(5).withColumns({"blockMortonCode": F.lit(far), "mortonCode": F.lit(far << 24)})
    assert GN.append_points(spark, root, apart) == 4
    before = _points_of(GN.read_generation(spark, root))
    old = GN.read_generation(spark, root)  # a reader of the old generation
    untouched = [r.file for r in GN.manifest(spark, root).where(f"lo = {far}").collect()]
    assert GN.compact(spark, root) == 5
    now = GN.read_generation(spark, root)
    assert _points_of(now) == _points_of(old) == _points_of(GN.read_generation(spark, root, 4)) == before
    assert now.groupBy("blockMortonCode", "part").count().where("count > 1").isEmpty()
    assert not old.groupBy("blockMortonCode", "part").count().where("count > 1").isEmpty()
    assert [r.file for r in GN.manifest(spark, root).where(f"lo = {far}").collect()] == untouched
    spans = sorted((r.lo, r.hi) for r in GN.manifest(spark, root).where("file IS NOT NULL").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert GN.compact(spark, root) == 5 and GN.generations(spark, root) == [1, 2, 3, 4, 5]
    assert GN.vacuum(spark, root) > 0 and GN.generations(spark, root) == [5] and _points_of(GN.read_generation(spark, root)) == before


def test_a_batch_is_appended_once_and_a_late_writer_fails(spark, coded):
    root = R.scratch_path(spark, "test-batches")
    assert GN.read_generation(spark, root).count() == 0 and GN.compact(spark, root) == 0
    some = coded.limit(200).cache()
    assert [GN.append_points(spark, root, some, batch=n) for n in (0, 1)] == [1, 2]
    GN.compact(spark, root)
    at = GN.generations(spark, root)[-1]
    assert GN.append_points(spark, root, some, batch=1) == at  # replayed after its files were compacted away
    assert len(_points_of(GN.read_generation(spark, root))) == 400
    with pytest.raises(RuntimeError, match="another writer"):
        GN._commit(spark, root, GN.manifest(spark, root), at - 1)
    assert GN.generations(spark, root)[-1] == at and len(_points_of(GN.read_generation(spark, root))) == 400


# ---------------------------------------------------------------------------
# Radius join by sweeps
# ---------------------------------------------------------------------------

@pytest.mark.parametrize("radius,part_rows", [(0.05, 40), (0.3, 40), (0.05, 10_000), (40.0, 50)])
def test_sweep_equals_brute_force(spark, radius, part_rows):
    rng = random.Random(3)
    rows = [(i, *[rng.uniform(-1, 1) for _ in range(3)]) for i in range(500)]
    rows += [(500 + i, *[k * radius for k in rng.choices(range(-3, 4), k=3)]) for i in range(100)]  # on cell borders
    rows += [(700, 0.0, 0.0, 0.0)] * 3 + [(800, None, 0.0, 0.0), (801, float("nan"), 0.0, 0.0), (802, float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double").repartition(5)
    got = sorted(map(tuple, NB.radius_join(df, radius, part_rows=part_rows).collect()))
    good = rows[:-3]
    want = sorted((a[0], b[0]) for a in good for b in good
                  if (b[1] - a[1]) * (b[1] - a[1]) + (b[2] - a[2]) * (b[2] - a[2]) + (b[3] - a[3]) * (b[3] - a[3]) <= radius * radius)
    assert got == want
    assert sorted(map(tuple, NB.radius_join(df, radius, part_rows=part_rows, hot_cell_rows=2).collect())) == want
    assert NB.radius_join(df.where("false"), radius).count() == 0


def test_sweep_copies_few_points(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, *[rng.random() for _ in range(3)]) for i in range(20_000)], "id long, x double, y double, z double")
    routed, parts = NB.routed_points(df, 0.008, part_rows=1000)
    assert parts == 20 and routed.where("home").count() == 20_000 and routed.count() < 1.5 * 20_000
    plan = _plan(NB.radius_join(df, 0.004, part_rows=1000))
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("pairs_of_row", [1, 100, 50_000])
def test_sweep_unfolds_pairs_of_crowded_places(pairs_of_row):
    """Rows at one place are swept once, so few ids leave the sweep for many pairs, and a row unfolds to a bounded number."""
    import pyarrow as pa
    from collections import Counter
    rng = random.Random(4)
    rows = [(i, 0.04 * (i % 30), float(i % 3), 0.0) for i in range(1800)]  # 30 places of 60 rows on lines
    rows += [(2000 + i, *[rng.uniform(0, 0.4) for _ in range(3)]) for i in range(200)]
    rng.shuffle(rows)
    home = [r[0] % 7 > 0 if r[0] >= 2000 else r[0] % 30 != 5 for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([3] * len(rows), pa.int32()), pa.array(home), *map(pa.array, zip(*rows))],
                                       ["part", "home", "id", "x", "y", "z"])
    out = [r for b in NB._sweep(0.1 * (1 + NB.CELL_MARGIN), 0.05 * 0.05, 10_000, pairs_of_row)([batch]) for r in b.to_pylist()]
    got = Counter((a, b) for r in out for a in r["currents"] for b in r["nearPoints"])
    want = Counter((a[0], b[0]) for a, h in zip(rows, home) if h for b in rows
                   if (b[1] - a[1]) * (b[1] - a[1]) + (b[2] - a[2]) * (b[2] - a[2]) + (b[3] - a[3]) * (b[3] - a[3]) <= 0.05 * 0.05)
    assert got == want
    assert all(len(r["currents"]) * len(r["nearPoints"]) <= pairs_of_row or len(r["currents"]) == 1 for r in out)
    if pairs_of_row == 50_000:
        assert sum(len(r["currents"]) + len(r["nearPoints"]) for r in out) * 10 < sum(want.values())


@pytest.mark.parametrize("kind", ["string", "struct<a:long,b:string>", "decimal(20,2)"])
def test_radius_join_ids_of_any_type(spark, kind):
    df = spark.range(60).select(F.when(F.col("id") != 7, F.col("id")).alias("n"), (F.col("id") % 20 / 10).alias("x"),
                                F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    made = F.struct(F.col("n").alias("a"), F.col("n").cast("string").alias("b")) if kind.startswith("struct") else F.col("n")
    df = df.select(made.cast(kind).alias("id"), "x", "y", "z")
    got = NB.radius_join(df, 0.15, part_rows=10)
    assert [f.dataType for f in got.schema] == [df.schema["id"].dataType] * 2
    rows = df.collect()
    want = sorted(repr((a.id, b.id)) for a in rows for b in rows if (b.x - a.x) * (b.x - a.x) <= 0.15 * 0.15)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


# ---------------------------------------------------------------------------
# Range set as streaming state
# ---------------------------------------------------------------------------

def test_pieces_cover_their_range(spark):
    rng = random.Random(8)
    rows = [(g, lo, min(lo + rng.choice([0, 1, 65535, 65536, 1 << 20, 1 << 40, 1 << 61]), (1 << 63) - 1))
            for g in range(3) for lo in (rng.randrange(1 << 62), rng.randrange(1 << 17), 65536 * rng.randrange(50))]
    rows += [(9, 0, (1 << 63) - 1), (9, 65535, 65536)]
    pieces = RS.range_pieces(spark.createDataFrame(rows, "g int, lo long, hi long"), ["g"]).collect()
    size = sum((p.b - p.a + 1) << (16 * p.tier) for p in pieces)
    assert size == sum(hi - lo + 1 for _, lo, hi in rows) and len(pieces) <= 8 * len(rows)
    assert all(0 <= p.a <= p.b <= 65535 for p in pieces)
    for bad in ((1, 5, 4), (1, None, 4), (1, -1, 4)):
        with pytest.raises(Exception, match="0 <= min <= max"):
            RS.range_pieces(spark.createDataFrame([bad], "g int, lo long, hi long"), ["g"]).collect()


def test_range_set_survives_restart_and_replay(spark):
    src, out, ckpt = (R.scratch_path(spark, f"test-set-{n}") for n in ("src", "out", "ckpt"))
    rng = random.Random(2)
    schema = "g string, lo long, hi long"

    def some(n, spread):
        return [(rng.choice("ab") if rng.random() < 0.9 else None, lo, lo + rng.randrange(60))
                for lo in (rng.randrange(spread) for _ in range(n))]

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        RS.start_range_set(stream, ["g"], out, ckpt, available_now=True).awaitTermination()

    rows = some(300, 30_000) + [("a", 10, 5_000_000_000), ("b", (1 << 63) - 50, (1 << 63) - 1)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(src)
    run()
    more = some(300, 200_000)
    spark.createDataFrame(more, schema).repartition(2).write.mode("append").parquet(src)
    run()  # a second query from the same checkpoint: only the new files are read

    def check(rows):
        want = RG.coalesce_ranges(spark.createDataFrame(rows, schema), groups=["g"])
        key = lambda r: (r[0] or "", *r[1:])
        assert sorted(map(tuple, RS.read_range_set(spark, out, ["g"]).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)

    check(rows + more)
    folder = ckpt.removeprefix("file:") + "/commits"
    last = max(int(n) for n in os.listdir(folder) if n.isdigit())
    for name in (str(last), f".{last}.crc"):  # as if the driver had died before it committed the last batch
        Path(folder, name).unlink(missing_ok=True)
    run()
    check(rows + more)


# ---------------------------------------------------------------------------
# Many pivots, periodic boxes, SQL functions
# ---------------------------------------------------------------------------

def _plain_cut(ranges, pivots):
    left = {}
    for g, lo, hi in ranges:
        left.setdefault(g, set()).update(range(lo, hi + 1))
    out = []
    for g, codes in left.items():
        codes -= {p for k, p in pivots if k == g}
        for c in sorted(codes):
            if out and out[-1][0] == g and out[-1][2] == c - 1:
                out[-1] = (g, out[-1][1], c)
            else:
                out.append((g, c, c))
    return out


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_subtracting_pivots(spark, parts):
    rng = random.Random(parts)
    ranges = [(rng.choice(["a", "b", None]), lo, lo + rng.randrange(30)) for lo in (rng.randrange(3000) for _ in range(120))]
    ranges += [("hot", 100, 9_000)]
    pivots = [(g, rng.randrange(3100)) for g in ("a", "b", None, "none") for _ in range(400)]
    pivots += [("hot", p) for p in range(0, 9_500, 3)] * 2 + [("hot", 9_000), ("hot", 100), ("a", None)]
    got = RG.subtract_pivots(spark.createDataFrame(ranges, "g string, lo long, hi long").repartition(3),
                             spark.createDataFrame(pivots, "g string, pivot long").repartition(5), groups=["g"], num_partitions=parts)
    key = lambda r: (r[0] or "", *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_plain_cut(ranges, pivots), key=key)


def test_subtracting_without_groups_pivots_or_ranges(spark):
    ranges = spark.createDataFrame([(5, 9), (20, 20)], "lo long, hi long")
    cut = lambda r, p: sorted(map(tuple, RG.subtract_pivots(r, p, groups=[]).collect()))
    none = spark.createDataFrame([], "pivot long")
    assert cut(ranges, none) == [(5, 9), (20, 20)]
    assert cut(ranges, spark.createDataFrame([(7,), (20,)], "pivot long")) == [(5, 6), (8, 9)]
    assert cut(ranges.where("false"), spark.createDataFrame([(7,)], "pivot long")) == []


@pytest.mark.parametrize("lon,t", [((170, -170), (0, 100)), ((-180, -170), (600_000, 5)), ((150, 400), (10, 604_900)), ((-10, 10), (0, 604_800)),
                                   ((175, 180), (604_700, 604_800))])
def test_periodic_boxes(spark, lon, t):
    boxes = ST.st_periodic_boxes(lon, (-10, 10), t)
    assert 1 <= len(boxes) <= 4
    on = lambda v, lo, hi, period: any(lo <= v + k * period <= (hi if hi >= lo else hi + period) for k in range(-3, 4))
    for x in range(-180, 181, 2):
        for s in (0, 3, 50, 500, 604_699, 604_750, 604_799):
            hits = sum(b[0][0] <= x <= b[0][1] and b[2][0] <= s <= b[2][1] for b in boxes)
            assert (hits > 0) == (on(x, *lon, 360) and on(s, *t, 604_800))


def test_periodic_filter_is_pushed_down_and_returns_each_event_once(spark):
    df = S.q_st_periodic_box(spark, SF_SMALL)
    assert "Or(" in _plan(df) and df.count() == df.select("id").distinct().count() > 0
    with pytest.raises(ValueError):
        ST.st_periodic_boxes((0, 1), (5, 4), (0, 1))


def test_sql_functions(spark):
    SQ.register(spark)
    rng = random.Random(1)
    cells = [tuple(rng.randrange(1 << 21) for _ in range(3)) for _ in range(50)] + [(0, 0, 0), ((1 << 21) - 1,) * 3]
    spark.createDataFrame(cells, "x long, y long, z long").createOrReplaceTempView("cells_of_test")
    rows = spark.sql("SELECT x, y, z, z_encode(x, y, z) AS c FROM cells_of_test").collect()
    assert all(r.c == enc(r.x, r.y, r.z) for r in rows)
    back = spark.sql("SELECT x, y, z, z_axis(c, 0) AS a, z_axis(c, 1) AS b, z_axis(code => c, dim => 2) AS d "
                     "FROM (SELECT *, z_encode(x, y, z) AS c FROM cells_of_test)").collect()
    assert all((r.a, r.b, r.d) == (r.x, r.y, r.z) for r in back)


def test_sql_ranges_hold_the_box(spark):
    SQ.register(spark)
    rng = random.Random(5)
    for _ in range(6):
        lo = [rng.randrange(40) for _ in range(3)]
        hi = [v + rng.randrange(12) for v in lo]
        ranges = [(r.lo, r.hi) for r in spark.sql(f"SELECT * FROM z_ranges({', '.join(map(str, lo + hi))})").collect()]
        assert 1 <= len(ranges) <= 4
        box = [enc(x, y, z) for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1) for z in range(lo[2], hi[2] + 1)]
        assert all(any(a <= c <= b for a, b in ranges) for c in box)
        assert min(a for a, _ in ranges) == min(box) and max(b for _, b in ranges) == max(box)


def test_sql_clip_reaches_the_scan_without_python(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(S.q_sql_functions_clip(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert pushed.count("GreaterThanOrEqual(blockMortonCode,") == 4 and "Or(" in pushed
    assert "Python" not in plan and "Join" not in plan
