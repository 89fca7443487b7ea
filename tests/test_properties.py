"""Property tests: round trips, monotonicity, cover
contains box, merged ranges canonical with the same union."""
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import dec, enc
from zpoints.functions import zcode as Z
from zpoints.operators import clip as CL
from zpoints.plans import cover as CV

cell = st.integers(min_value=0, max_value=(1 << 21) - 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=60))
def test_encode_matches_definition_and_decodes(spark, pts):
    df = spark.createDataFrame(pts, "x long, y long, z long")
    for r in Z.with_decoded(Z.with_morton(df, "x", "y", "z"), "mortonCode").collect():
        assert r.mortonCode == enc(r.x, r.y, r.z)
        assert (r.cx, r.cy, r.cz) == (r.x, r.y, r.z) == dec(r.mortonCode)


@settings(max_examples=200, deadline=None)
@given(cell, cell, cell, st.integers(min_value=0, max_value=2))
def test_per_axis_monotone(x, y, z, axis):
    p = [x, y, z]
    q = list(p)
    if q[axis] < (1 << 21) - 1:
        q[axis] += 1
        assert enc(*q) > enc(*p)


small = st.integers(min_value=0, max_value=40)


@settings(max_examples=4, deadline=None)
@given(st.tuples(small, small, small), st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(0, 6)))
def test_cover_contains_box(spark, lo, size):
    hi = tuple(a + b for a, b in zip(lo, size))
    rs = sorted((r.lo, r.hi) for r in CV.zranges(CV.box_table(spark, [(0, *lo, *hi)])).collect())
    for (l1, h1), (l2, h2) in zip(rs, rs[1:]):
        assert h1 + 1 < l2
    for x in range(lo[0], hi[0] + 1):
        for y in range(lo[1], hi[1] + 1):
            for z in range(lo[2], hi[2] + 1):
                c = enc(x, y, z)
                assert any(a <= c <= b for a, b in rs)


axis_range = st.tuples(st.integers(0, (1 << 21) - 1), st.integers(0, (1 << 21) - 1)).map(sorted)


@settings(max_examples=60, deadline=None)
@given(axis_range, axis_range, axis_range, st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1), st.floats(0, 1)), max_size=20))
def test_frontier_is_short_and_holds_the_box(x, y, z, inside):
    cells = tuple(zip(x, y, z))
    rs = CL.frontier_ranges(cells)
    assert 1 <= len(rs) <= CL.MAX_OR_TERMS
    for (l1, h1), (l2, h2) in zip(rs, rs[1:]):
        assert h1 + 1 < l2
    corners = [(a, b, c) for a in x for b in y for c in z]
    for p in corners + [tuple(lo + int(f * (hi - lo)) for f, (lo, hi) in zip(fs, (x, y, z))) for fs in inside]:
        assert any(a <= enc(*p) <= b for a, b in rs)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 6)), min_size=1, max_size=80))
def test_merge_same_union(spark, spans):
    rows = [(1, lo, lo + w) for lo, w in spans]
    got = sorted((r.lo, r.hi) for r in CV.coalesce_ranges(
        spark.createDataFrame(rows, "box_id int, lo long, hi long")).collect())
    covered = set(v for _, lo, hi in rows for v in range(lo, hi + 1))
    assert set(v for lo, hi in got for v in range(lo, hi + 1)) == covered
    for (l1, h1), (l2, h2) in zip(got, got[1:]):
        assert h1 + 1 < l2
