from pyspark.sql import functions as F

from conftest import SF_SMALL
from zpoints import registry as R
from zpoints.operators import blocks as BL
from zpoints.operators import extent as EX
from zpoints.operators.bounded import collect_bounded
from zpoints.sources import clouds as CD


def test_blocks_hold_every_point_sorted(spark):
    coded = EX.encode_points(CD.lineitem_cloud(spark, SF_SMALL))
    blocks = BL.collect_blocks(coded)
    back = BL.unnest_blocks(blocks)
    assert back.count() == coded.count()
    assert back.exceptAll(coded.select(*back.columns)).count() == 0
    for r in blocks.select(F.col("points.mortonCode").alias("c")).collect():
        assert r.c == sorted(r.c)


def test_hot_block_is_split_into_parts(spark):
    # one block holds every row, and many rows are exact copies
    rows = [(1.0, 1.0, 1.0, 1, 0, 1, 2, 3)] * 700 + [(1.0 + i * 1e-3, 1.0, 1.0, 1, 0, 1, 2, 3) for i in range(50)]
    pts = spark.createDataFrame(rows, "x double, y double, z double, intensity int, classification byte, "
                                      "red short, green short, blue short")
    coded = EX.encode_points(pts)
    blocks = BL.collect_blocks(coded, max_points_per_row=100)
    sizes = [r.n for r in blocks.select(F.size("points").alias("n")).collect()]
    assert sum(sizes) == 750
    assert len(sizes) >= 8 and max(sizes) <= 100


def test_collect_bounded_keeps_small_groups_whole(spark):
    df = spark.createDataFrame([(k, v) for k in range(5) for v in range(k + 1)], "k int, v int")
    out = collect_bounded(df, ["k"], F.col("v"), "vs", max_per_row=10).collect()
    assert sorted((r.k, r.part, r.vs) for r in out) == [(k, 0, list(range(k + 1))) for k in range(5)]


def test_occupancy_and_counts(spark):
    coded = EX.encode_points(CD.lineitem_cloud(spark, SF_SMALL), resolution=13)
    occ = BL.block_occupancy(coded).collect()
    assert sum(r.n_points for r in occ) == coded.count()
    assert occ[0].n_codes >= occ[-1].n_codes
    top = BL.zorder_topk(coded, 5).collect()
    assert [(r.blockMortonCode, r.mortonCode) for r in top] == sorted((r.blockMortonCode, r.mortonCode) for r in top)


def test_hot_keys_interleaved_or_null_are_split(spark):
    rows = [(None if i % 4 == 3 else i % 4, i) for i in range(4000)] + [(9, 1)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = collect_bounded(df, ["k"], F.col("v"), "vs", max_per_row=250).collect()
    assert max(len(r.vs) for r in out) <= 250
    assert sorted((r.k is None, r.k or 0, v) for r in out for v in r.vs) == sorted((k is None, k or 0, v) for k, v in rows)
    assert len({(r.k, r.part) for r in out}) == len(out)
    again = collect_bounded(df.repartition(7), ["k"], F.col("v"), "vs", max_per_row=250).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))  # parts follow from the rows, not their order


def test_points_outside_a_given_extent(spark):
    import pytest
    pts = spark.createDataFrame([(1.0, 1.0, 1.0), (0.5, 1.0, 1.0), (5000.0, 1.0, 1.0)], "x double, y double, z double")
    ext = dict(zip(EX.EXTENT_COLUMNS, (1.0, 1.0, 1.0, 9.0, 9.0, 9.0)))
    with pytest.raises(Exception, match="outside the extent"):
        EX.encode_points(pts, ext).collect()
    inside, outside = EX.split_outside(pts, ext)
    assert [r.x for r in inside.collect()] == [1.0] and sorted(r.x for r in outside.collect()) == [0.5, 5000.0]
    assert EX.normalize_coords(pts, ext, outside="wrap").count() == 3
    with pytest.raises(ValueError):
        EX.scaled_codes(spark.createDataFrame([(0, 0, 0), (3_000_000, 0, 0)], "X int, Y int, Z int"))


def _far_cloud(spark, tmp_path):
    """lineitem rows whose codes are near the top: a block's sum of them passes a bigint several times."""
    rows = [(i, 7, 9, 1 + i % 7, 2097.0, 2_097_000.0 - i, 20.97) for i in range(130)] + [(500, 7, 9, 1, 0.0, 0.0, 0.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    codes = [r.mortonCode for r in R._coded(spark, str(tmp_path)).select("mortonCode").collect()]
    wanted = {}
    for c in codes:
        b = c >> 3 * R.COARSE_RES
        wanted[b] = (wanted.get(b, (0, 0))[0] + 1, wanted.get(b, (0, 0))[1] + c)
    assert max(total for _, total in wanted.values()) > 1 << 64
    return {b: (n, (total + (1 << 63)) % (1 << 64) - (1 << 63)) for b, (n, total) in wanted.items()}


def test_point_sums_of_a_block_may_pass_a_bigint(spark, tmp_path):
    wanted = _far_cloud(spark, tmp_path)
    got = R.q_blocks_hot_parts(spark, str(tmp_path)).collect()
    assert {r.blockMortonCode: (r.n_points, r.code_sum) for r in got} == wanted
    assert all(r.within_cap and r.parts_differ and r.none_empty for r in got)
    assert sum(r.n_points for r in R.q_blocks_collect(spark, str(tmp_path)).collect()) == 131


def test_code_sums_of_a_block_may_pass_a_bigint(spark, tmp_path):
    wanted = _far_cloud(spark, tmp_path)
    got = R.q_codes_hot_parts(spark, str(tmp_path)).collect()
    assert {r.blockMortonCode: (r.n_points, r.code_sum) for r in got} == wanted
    assert sum(r.n_codes for r in R.q_codes_per_block(spark, str(tmp_path)).collect()) == 131
