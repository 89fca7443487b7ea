from pyspark.sql import functions as F

from conftest import enc
from zpoints.plans import cover as CV
from zpoints.operators import clip as CL


def _cover(spark, boxes):
    r = CV.zranges(CV.box_table(spark, boxes)).collect()
    out = {}
    for row in r:
        out.setdefault(row.box_id, []).append((row.lo, row.hi))
    return {k: sorted(v) for k, v in out.items()}


def test_golden_boxes(spark):
    boxes = [(2, 11, 8, 0, 17, 12, 4), (3, 5, 6, 7, 20, 21, 22), (4, 0, 0, 0, 7, 7, 7),
             (5, 1, 1, 1, 1000, 1000, 1000)]
    octs = dict(CV.cover_octants(CV.box_table(spark, boxes[:1])).groupBy("box_id").count().collect())
    assert octs[2] == 84
    cov = _cover(spark, boxes)
    b2 = cov[2]
    assert len(b2) == 50 and sum(h - l + 1 for l, h in b2) == 175
    assert b2[:4] == [(1545, 1545), (1547, 1547), (1549, 1549), (1551, 1551)]
    assert b2[-1] == (5504, 5505)
    assert max(b2, key=lambda r: r[1] - r[0]) == (1599, 1663)
    assert sum(h - l + 1 for l, h in cov[3]) == 4096
    assert cov[4] == [(0, 511)]
    assert len(cov[5]) == 6883 and sum(h - l + 1 for l, h in cov[5]) == 1024192512


def test_cover_contains_box_and_is_canonical(spark):
    boxes = [(1, 3, 0, 5, 9, 6, 8), (2, 30, 31, 29, 34, 33, 37), (3, 6, 6, 6, 6, 6, 6)]
    cov = _cover(spark, boxes)
    for bid, x0, y0, z0, x1, y1, z1 in boxes:
        rs = cov[bid]
        for (l1, h1), (l2, h2) in zip(rs, rs[1:]):
            assert h1 + 1 < l2  # disjoint and not adjacent
        for x in range(x0, x1 + 1):
            for y in range(y0, y1 + 1):
                for z in range(z0, z1 + 1):
                    c = enc(x, y, z)
                    assert any(l <= c <= h for l, h in rs)


def test_inverted_box_rejected(spark):
    import pytest
    with pytest.raises(Exception):
        CV.zranges(CV.box_table(spark, [(1, 5, 5, 5, 4, 6, 6)])).collect()


def test_coalesce_golden(spark):
    df = spark.createDataFrame([(0, 2, 3), (0, 5, 6), (0, 1, 4), (1, 1, 2), (1, 3, 4), (2, 1, 1), (2, 3, 3)],
                               "box_id int, lo long, hi long")
    got = sorted((r.box_id, r.lo, r.hi) for r in CV.coalesce_ranges(df).collect())
    assert got == [(0, 1, 6), (1, 1, 4), (2, 1, 1), (2, 3, 3)]


def test_coarsen_is_superset():
    rs = [(1, 2), (5, 6), (10, 10), (100, 120), (200, 201)]
    c = CL.coarsen(rs, 2)
    assert len(c) == 2
    for l, h in rs:
        assert any(a <= l and h <= b for a, b in c)
