import pytest

from conftest import SF_SMALL
from zpoints import registry as R
from zpoints.operators import blocks as BL
from zpoints.operators import extent as EX
from zpoints.sources import clouds as CD
from zpoints.sources import io as IO
from zpoints.streaming import ingest as SI

SCHEMA = "x double, y double, z double, intensity int, classification byte, red short, green short, blue short"


def test_empty_cloud_raises(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        EX.encode_points(empty)


def test_extent_past_21_bits_raises_and_edge_fits(spark):
    fits = spark.createDataFrame([(0.0, 0.0, 0.0, 1, 0, 0, 0, 0), (2097.151, 0.0, 0.0, 1, 0, 0, 0, 0)], SCHEMA)
    codes = sorted(r.mortonCode for r in EX.encode_points(fits).collect())
    assert codes[-1] == 1 + sum(1 << (3 * i) for i in range(1, 21))  # x cell 2097151
    too_big = spark.createDataFrame([(0.0, 0.0, 0.0, 1, 0, 0, 0, 0), (2097.152, 0.0, 0.0, 1, 0, 0, 0, 0)], SCHEMA)
    with pytest.raises(ValueError):
        EX.encode_points(too_big)


def test_one_point_and_duplicates(spark):
    one = spark.createDataFrame([(5.0, 5.0, 5.0, 1, 0, 0, 0, 0)] * 3, SCHEMA)
    blocks = BL.collect_blocks(EX.encode_points(one)).collect()
    assert len(blocks) == 1 and len(blocks[0].points) == 3 and blocks[0].blockMortonCode == 0


def test_streaming_ingest_over_several_batches(spark):
    pts = CD.lineitem_cloud(spark, SF_SMALL)
    src = R.scratch_path(spark, "test-stream-src")
    IO.write_points_text(pts.repartition(3), src)
    ext = EX.extent_values(pts)
    stream = CD.flatten_loaded(SI.read_points_text_stream(spark, src, max_files_per_trigger=1))
    out, ckpt = R.scratch_path(spark, "test-stream-out"), R.scratch_path(spark, "test-stream-ckpt")
    q = SI.start_block_ingest(SI.encode_stream(stream, ext), out, ckpt, available_now=True)
    q.awaitTermination()
    stored = SI.read_stream_blocks(spark, out)
    assert stored.select("batch_id").distinct().count() >= 2
    back = BL.unnest_blocks(stored)
    want = EX.encode_points(pts, ext)
    assert back.count() == pts.count()
    assert back.exceptAll(want.select(*back.columns)).count() == 0


def test_points_without_scale_factors_raise(spark):
    catalog = spark.createDataFrame([(1, 0.5, 0.5, 0.5)], "id int, scaleX double, scaleY double, scaleZ double")
    known = spark.createDataFrame([(1.0, 2.0, 3.0, 1, 0, 0, 0, 0)] * 2, SCHEMA)
    assert [(r.X, r.Y, r.Z) for r in EX.scale_points_by_catalog(known, catalog, "intensity").collect()] == [(2, 4, 6)] * 2
    for cloud in (None, 7):
        lost = spark.createDataFrame([(1.0, 2.0, 3.0, 1, 0, 0, 0, 0), (1.0, 2.0, 3.0, cloud, 0, 0, 0, 0)], SCHEMA)
        scaled = EX.scale_points_by_catalog(lost, catalog, "intensity")
        assert scaled.count() == 2
        with pytest.raises(Exception, match="no scale factors"):
            scaled.collect()
