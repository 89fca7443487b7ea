"""Box queries over blocks and point tables.

One box, of any size, becomes one predicate: a disjunction of at most 32
``BETWEEN`` terms on the code column, which Spark pushes into the parquet scan
(row groups and files whose code range misses every term are skipped), and an
exact ``BETWEEN`` per axis on the decoded code. Nothing switches on the size of
the box, and no job or fetch precedes the scan. A table of boxes becomes a
table of Z-ranges (``plans.cover``), applied with ``range_join``: an equi-join
on code bins plus an exact ``BETWEEN``. No nested-loop join is planned.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zpoints.functions.zcode import AXIS0_BITS, _shr, decode_axis, with_decoded
from zpoints.operators.blocks import unnest_blocks
from zpoints.plans.cover import zranges
from zpoints.schema import MAX_MASK, PRECISION, RESOLUTION, precision_factor

MAX_OR_TERMS = 32    # terms of the coarse predicate pushed to parquet
FINE_BIN_BITS = 12   # 4096 codes per bin for the shortest ranges
BINS_PER_RANGE = 32  # a range explodes to at most about this many bins


# ---------------------------------------------------------------------------
# Box arithmetic (six numbers per box, driver side)
# ---------------------------------------------------------------------------

def box_to_cells(extent_min: Sequence[float], box_min: Sequence[float], box_max: Sequence[float],
                 precision: float = PRECISION, compat: bool = False):
    """Coordinates -> inclusive integer cells relative to the extent minimum.

    Points are quantised by rounding; by default the box corners are rounded
    the same way, which is monotone, so no point inside the box is missed.
    ``compat=True`` truncates the corners instead (the original behaviour).
    Returns None when the box lies outside the 21-bit cell space.
    """
    f = precision_factor(precision)
    def q(v, m):
        s = (v - m) * f
        return int(s) if compat else _round_half_up(s)
    lo = [q(b, m) for b, m in zip(box_min, extent_min)]
    hi = [q(b, m) for b, m in zip(box_max, extent_min)]
    if any(l > h for l, h in zip(lo, hi)):
        raise ValueError(f"inverted box: min {box_min} > max {box_max} on some axis")
    if any(h < 0 or l > MAX_MASK for l, h in zip(lo, hi)):
        return None
    lo = [max(0, l) for l in lo]
    hi = [min(MAX_MASK, h) for h in hi]
    return tuple(lo), tuple(hi)


def _round_half_up(v: float) -> int:
    """Like Spark's round on a double: half up on its shortest decimal form."""
    from decimal import ROUND_HALF_UP, Decimal
    return int(Decimal(repr(float(v))).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def block_cells(cells, resolution: int = RESOLUTION):
    lo, hi = cells
    return tuple(c >> resolution for c in lo), tuple(c >> resolution for c in hi)


# ---------------------------------------------------------------------------
# One box as a literal predicate
# ---------------------------------------------------------------------------

def _enc(x: int, y: int, z: int) -> int:
    return sum((((x >> i) & 1) << (3 * i)) | (((y >> i) & 1) << (3 * i + 1)) | (((z >> i) & 1) << (3 * i + 2))
               for i in range(21))


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with overlapping or adjacent ranges joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


MAX_SPLITS = 512      # divisions of a box on the driver
DEAD_SHARE = 0.01     # codes outside the box, as a share of its cells, that are not worth another division


def frontier_ranges(cells, max_terms: int = MAX_OR_TERMS, max_splits: int = MAX_SPLITS) -> list[tuple[int, int]]:
    """At most ``max_terms`` code ranges that hold every code of a box, however large the box is.

    A box is one code interval from the code of its low corner to that of its
    high corner, with dead space: codes of cells outside the box. Divided at
    the highest bit in which the two codes differ, it becomes the boxes
    [low, litmax] and [bigmin, high], and the codes between litmax and bigmin
    drop out. The box with the most dead space is divided next, until
    ``max_splits`` divisions are done or the dead space left is below
    ``DEAD_SHARE`` of the box. Of the gaps found, the widest
    ``max_terms - 1`` stay open. The work is bounded by ``max_splits``
    whatever the box: integer steps on the driver, no job.
    """
    import heapq
    lo, hi = ([int(c) for c in side] for side in cells)

    def dead(zlo, zhi, lo, hi):
        return zhi - zlo + 1 - (hi[0] - lo[0] + 1) * (hi[1] - lo[1] + 1) * (hi[2] - lo[2] + 1)

    zlo, zhi = _enc(*lo), _enc(*hi)
    left = dead(zlo, zhi, lo, hi)
    enough = DEAD_SHARE * (zhi - zlo + 1 - left)
    heap = [(-left, zlo, zhi, lo, hi)]
    gaps: list[tuple[int, int]] = []  # (last code before, first code after)
    for _ in range(max_splits):
        if left <= enough:
            break
        waste, zlo, zhi, lo, hi = heapq.heappop(heap)
        bit = (zlo ^ zhi).bit_length() - 1
        level, axis = divmod(bit, 3)
        top = 1 << bit
        below = AXIS0_BITS << axis & (top - 1)  # the lower bits of the same axis
        litmax = zhi & ~(below | top) | below
        bigmin = zlo & ~(below | top) | top
        cut = hi[axis] >> level << level  # the first cell of the upper half
        lower_hi, upper_lo = list(hi), list(lo)
        lower_hi[axis], upper_lo[axis] = cut - 1, cut
        left += waste
        for half in ((zlo, litmax, lo, lower_hi), (bigmin, zhi, upper_lo, hi)):
            d = dead(*half)
            left += d
            heapq.heappush(heap, (-d, *half))
        if bigmin > litmax + 1:
            gaps.append((litmax, bigmin))
    open_gaps = sorted(heapq.nlargest(max_terms - 1, gaps, key=lambda g: (g[1] - g[0], -g[0])))
    zlo, zhi = _enc(*cells[0]), _enc(*cells[1])
    return list(zip([zlo, *(g[1] for g in open_gaps)], [*(g[0] for g in open_gaps), zhi]))


def coarsen(ranges, max_terms: int = MAX_OR_TERMS):
    """Merge the ranges separated by the smallest gaps until at most
    ``max_terms`` remain: a superset, for pushdown to parquet statistics."""
    ranges = sorted(ranges)
    if len(ranges) <= max_terms:
        return ranges
    gaps = sorted(range(len(ranges) - 1), key=lambda i: ranges[i + 1][0] - ranges[i][1])
    cut = sorted(gaps[len(ranges) - max_terms:])  # the widest gaps stay open
    out, start = [], ranges[0][0]
    for i in cut:
        out.append((start, ranges[i][1]))
        start = ranges[i + 1][0]
    out.append((start, ranges[-1][1]))
    return out


def axis_sql(code_col: str, dim: int) -> str:
    """SQL text of the cell of axis ``dim`` of a code column."""
    return "(" + " | ".join(f"shiftleft(shiftright({code_col}, {3 * i + dim}) & 1L, {i})" for i in range(21)) + ")"


def box_predicate_sql(code_col: str, cells) -> str:
    """SQL text that is true for exactly the codes of a box: a coarse OR of at
    most MAX_OR_TERMS BETWEENs, which reaches the parquet scan, and an exact
    BETWEEN per axis on the decoded code. The same shape for every box."""
    coarse = ranges_sql(code_col, frontier_ranges(cells))
    exact = " AND ".join(f"{axis_sql(code_col, d)} BETWEEN {l} AND {h}" for d, (l, h) in enumerate(zip(*cells)))
    return f"({coarse}) AND {exact}"


def box_predicate(code_col: str, cells):
    """The same predicate as a Column."""
    return F.expr(box_predicate_sql(code_col, cells))


def any_of(terms):
    """OR of many predicates as a balanced tree (depth log2 n)."""
    terms = list(terms)
    if not terms:
        return F.lit(False)
    while len(terms) > 1:
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def ranges_sql(code_col: str, ranges: Iterable[tuple[int, int]]) -> str:
    """The OR of BETWEENs as SQL text (codes are integers, so no quoting)."""
    parts = [f"({code_col} BETWEEN {int(lo)} AND {int(hi)})" for lo, hi in ranges]
    return " OR ".join(parts) if parts else "FALSE"


def range_join(left: DataFrame, ranges: DataFrame, code_col: str,
               fine_bits: int = FINE_BIN_BITS, bins_per_range: int = BINS_PER_RANGE,
               keys: Sequence[str] = (), broadcast: bool = False) -> DataFrame:
    """Rows of ``left`` joined to every range (lo, hi, + any columns) that
    contains ``left[code_col]`` and, with ``keys``, has equal values in these columns of both sides.

    Ranges are sorted into tiers by length; tier t uses bins of
    ``2**(fine_bits + step * t)`` codes, so every range spans at most about
    ``bins_per_range`` bins of its tier. ``left`` is read once: each row gets
    one (tier, bin) pair per tier that occurs, and a single equi-join on the
    pair (broadcast when AQE measures the exploded ranges small, otherwise a
    sort-merge join whose skewed bins AQE splits) is followed by the exact
    BETWEEN. The distinct tiers are a handful of integers.
    ``broadcast`` is for ranges known to be few: ``left`` is then not shuffled
    (AQE shuffles both sides before it measures them).
    """
    from zpoints.session import checkpoint_dir
    step = max(1, (bins_per_range - 1).bit_length())
    width = F.length(F.bin(F.col("hi") - F.col("lo")))
    tier = F.greatest(F.lit(0), F.ceil((width - F.lit(fine_bits + step)) / step)).cast("int")
    # the range table (covers, chunk lists: small next to the points) is
    # pinned with a reliable checkpoint, so finding its tiers and joining it
    # compute its lineage once
    checkpoint_dir(ranges.sparkSession)
    tiered = ranges.withColumn("__tier", tier).checkpoint(eager=True)
    tiers = sorted(r[0] for r in tiered.select("__tier").distinct().collect())
    if not tiers:  # no ranges: an empty result with the joined columns
        extra = [F.lit(None).cast(t).alias(n) for n, t in ranges.dtypes if n not in left.columns]
        return left.filter(F.lit(False)).select(*left.columns, *extra)
    shift = f"{fine_bits} + {step} * __tier"
    binned = tiered.withColumn("__bin", F.explode(F.sequence(F.expr(f"shiftright(lo, {shift})"),
                                                             F.expr(f"shiftright(hi, {shift})"))))
    if broadcast:
        binned = F.broadcast(binned)
    # the pairs come out of a Generate, so the join key is no expression of
    # the code that the optimizer could copy; a null code has no pair
    pairs = F.filter(F.transform(F.array(*[F.lit(t) for t in tiers]), lambda t: F.struct(
        t.alias("__tier"), F.call_function("shiftright", F.col(code_col), F.lit(fine_bits) + F.lit(step) * t).alias("__bin"))),
        lambda p: p["__bin"].isNotNull())
    keyed = left.select("*", F.inline(pairs))
    return (keyed.join(binned, on=[*keys, "__tier", "__bin"]).filter(F.col(code_col).between(F.col("lo"), F.col("hi")))
                 .drop("__tier", "__bin"))


# ---------------------------------------------------------------------------
# Clip
# ---------------------------------------------------------------------------

def clip_blocks_cells(blocks: DataFrame, bcells, code_col: str = "blockMortonCode",
                      pushdown: bool = True) -> DataFrame:
    """Whole blocks (or any rows with a code column) whose code lies in the
    box ``bcells`` = ((x0, y0, z0), (x1, y1, z1)), in the same cell space as the codes.

    ``pushdown=True`` is for stored tables: the coarse ranges reach the
    parquet scan. When the code column is computed in the same plan, pass
    ``pushdown=False``: the code is then bound once, in a lambda, instead of
    being copied into every term.
    """
    if bcells is None:
        return blocks.filter(F.lit(False))
    if pushdown:
        return blocks.filter(box_predicate(code_col, bcells))
    return blocks.filter(code_bound_once(code_col, bcells))


def code_bound_once(code_col: str, cells):
    """Exact per-axis test that evaluates the code expression a single time."""
    lo, hi = cells
    return F.exists(F.array(F.col(code_col)), lambda c: reduce(
        lambda a, b: a & b, [decode_axis(c, d).between(lo[d], hi[d]) for d in range(3)]))


def clip(blocks: DataFrame, extent_min, box_min, box_max, precision: float = PRECISION,
         resolution: int = RESOLUTION, compat: bool = False) -> DataFrame:
    """Blocks selected by a box given in coordinates."""
    cells = box_to_cells(extent_min, box_min, box_max, precision, compat)
    return clip_blocks_cells(blocks, None if cells is None else block_cells(cells, resolution))


def exact_cells_filter(points: DataFrame, cells, code_col: str = "mortonCode", pushdown: bool = True) -> DataFrame:
    """Keep points whose cells lie in the box (exact refinement).

    Uses the quantised cells (normX/Y/Z) when the rows still carry them, and
    decodes the code otherwise (``pushdown`` as in ``clip_blocks_cells``)."""
    (x0, y0, z0), (x1, y1, z1) = cells
    if {"normX", "normY", "normZ"} <= set(points.columns):
        return points.filter(F.col("normX").between(x0, x1) & F.col("normY").between(y0, y1)
                             & F.col("normZ").between(z0, z1))
    if not pushdown:
        return points.filter(code_bound_once(code_col, cells))
    d = with_decoded(points, code_col, out=("__cx", "__cy", "__cz"))
    d = d.filter(F.col("__cx").between(x0, x1) & F.col("__cy").between(y0, y1) & F.col("__cz").between(z0, z1))
    return d.drop("__cx", "__cy", "__cz")


def clip_points(blocks: DataFrame, cells, resolution: int = RESOLUTION, pushdown: bool = True) -> DataFrame:
    """Exact points of a box (cells at point precision) from a blocks table:
    block ranges (pushed to the scan), unnest, exact per-point filter."""
    if cells is None:
        return unnest_blocks(blocks).filter(F.lit(False))
    chosen = clip_blocks_cells(blocks, block_cells(cells, resolution), pushdown=pushdown)
    return exact_cells_filter(unnest_blocks(chosen), cells)


def clip_coded_points(coded: DataFrame, cells, resolution: int = RESOLUTION, pushdown: bool = False) -> DataFrame:
    """Exact points of a box from a flat coded-point table: one filter, no join.
    For a stored table (``pushdown``), block ranges reach the scan first."""
    if cells is None:
        return coded.filter(F.lit(False))
    chosen = clip_blocks_cells(coded, block_cells(cells, resolution)) if pushdown else coded
    return exact_cells_filter(chosen, cells, pushdown=pushdown)


def cube_cells(center, half_width: int):
    """Box of +-half_width cells around a centre cell, clamped to the code space."""
    lo = tuple(max(0, c - half_width) for c in center)
    hi = tuple(min(MAX_MASK, c + half_width) for c in center)
    return lo, hi


def clip_many_boxes(coded: DataFrame, boxes: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """Exact (box_id, point) pairs for a table of boxes in point cells
    (box_id, x0, y0, z0, x1, y1, z1): block-level covers for all boxes in one
    job, a binned range join on blockMortonCode, then the exact per-axis test
    against the box columns carried by the join."""
    shifted = boxes.select("box_id", *[_shr(F.col(c).cast("long"), resolution).alias(c)
                                       for c in ["x0", "y0", "z0", "x1", "y1", "z1"]])
    cover = zranges(shifted)
    # carry the point-level box onto its ranges (both sides keyed by box_id;
    # AQE broadcasts the smaller one when it measures it small)
    cover = cover.join(boxes.select(
        "box_id", *[F.col(c).cast("long").alias(f"__b{c}") for c in ["x0", "y0", "z0", "x1", "y1", "z1"]]),
        on="box_id")
    joined = range_join(coded, cover, "blockMortonCode")
    d = with_decoded(joined, "mortonCode", out=("__cx", "__cy", "__cz"))
    d = d.filter(F.col("__cx").between(F.col("__bx0"), F.col("__bx1"))
                 & F.col("__cy").between(F.col("__by0"), F.col("__by1"))
                 & F.col("__cz").between(F.col("__bz0"), F.col("__bz1")))
    return d.drop("__cx", "__cy", "__cz", "lo", "hi", *[f"__b{c}" for c in ["x0", "y0", "z0", "x1", "y1", "z1"]])
