import random

from pyspark.sql import functions as F

from conftest import dec, enc
from zpoints.functions import zcode as Z


def test_golden_encodes(spark):
    df = spark.createDataFrame([(1, 2, 3), (2097151, 2097151, 2097151), (0, 0, 0)], "x long, y long, z long")
    rows = Z.with_morton(df, "x", "y", "z").select("mortonCode").collect()
    assert [r[0] for r in rows] == [53, 9223372036854775807, 0]


def test_encode_decode_roundtrip_and_reference(spark):
    random.seed(7)
    pts = [tuple(random.randrange(1 << 21) for _ in range(3)) for _ in range(500)] + [(2097151, 0, 1)]
    df = spark.createDataFrame(pts, "x long, y long, z long")
    out = Z.with_decoded(Z.with_morton(df, "x", "y", "z"), "mortonCode").collect()
    for r in out:
        assert r["mortonCode"] == enc(r["x"], r["y"], r["z"])
        assert (r["cx"], r["cy"], r["cz"]) == (r["x"], r["y"], r["z"])


def test_past_21_bits_wraps(spark):
    df = spark.createDataFrame([(2097152, 0, 0)], "x long, y long, z long")
    assert Z.with_morton(df, "x", "y", "z").first()["mortonCode"] == 0


def test_block_code_is_shifted_code_and_code_of_shifted_cells(spark):
    random.seed(3)
    pts = [tuple(random.randrange(1 << 21) for _ in range(3)) for _ in range(200)]
    df = spark.createDataFrame(pts, "x long, y long, z long")
    df = Z.with_morton(df, "x", "y", "z").withColumn("b", Z.block_code("mortonCode", 8))
    for r in df.collect():
        assert r["b"] == enc(r["x"] >> 8, r["y"] >> 8, r["z"] >> 8)


def test_common_prefix(spark):
    df = spark.createDataFrame([(1545, 5505), (77, 77), (0, (1 << 62)), (8, 15)], "lo long, hi long")
    out = df.select(Z.common_prefix("lo", "hi").alias("p")).collect()
    got = [(r.p.prefix, r.p.bits) for r in out]
    assert got[0] == (0, 48)
    assert got[1] == (77, 63)
    assert got[2] == (0, 0)
    assert got[3] == (8, 60)


def test_bigmin_litmax_against_brute_force(spark):
    random.seed(11)
    rows = []
    while len(rows) < 150:
        lo = [random.randint(0, 12) for _ in range(3)]
        hi = [v + random.randint(0, 5) for v in lo]
        rmin, rmax = enc(*lo), enc(*hi)
        if rmin >= rmax:
            continue
        xd = random.randint(0, enc(20, 20, 20))
        if all(lo[i] <= dec(xd)[i] <= hi[i] for i in range(3)):
            continue
        inbox = [enc(x, y, z) for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1)
                 for z in range(lo[2], hi[2] + 1)]
        rows.append((xd, rmin, rmax, min([c for c in inbox if c > xd], default=0),
                     max([c for c in inbox if c < xd], default=0)))
    df = spark.createDataFrame(rows, "xd long, rmin long, rmax long, big long, lit long")
    r = df.withColumn("r", Z.bigmin_litmax("xd", "rmin", "rmax"))
    assert r.filter((F.col("r.bigmin") != F.col("big")) | (F.col("r.litmax") != F.col("lit"))).count() == 0


def test_relations(spark):
    df = spark.createDataFrame([(0, 10, 3, 4)], "a long, b long, c long, d long")
    r = df.select(Z.range_overlaps("a", "b", "c", "d").alias("o1"), Z.range_overlaps("c", "d", "a", "b").alias("o2"),
                  Z.range_overlaps_compat("c", "d", "a", "b").alias("compat"),
                  Z.range_contains_range("a", "b", "c", "d").alias("cont")).first()
    assert r.o1 and r.o2 and r.cont
    assert not r.compat  # the original test misses an enclosing range


def test_decode_axis_rejects_bad_dimension():
    import pytest
    with pytest.raises(ValueError):
        Z.decode_axis("c", 3)
