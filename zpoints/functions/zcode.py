"""Morton (Z-order) code functions as native Spark column expressions.

Bit layout of a code: x in bits 0, 3, 6, ...; y in 1, 4, 7, ...; z in
2, 5, 8, ...; 21 bits per axis, 63 bits in total. Inputs past 21 bits are
masked (they wrap), as the layout has no room for them.

Every function here builds an expression whose size is linear in the number
of bits: each input is referenced a fixed number of times. That matters
because Catalyst copies a projected expression into any filter it pushes
below the projection (including the not-null filters it infers for join
keys); a form whose stages each reference the previous stage twice grows
exponentially when copied. Encoding spreads each axis byte by byte through a
256-entry table (a literal array, folded to a constant and indexed in
generated code); decoding ORs the 21 axis bits together. No Python UDF is
involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zpoints.schema import DEPTH_LIMIT_DEFAULT, DEPTH_LIMITS, LONG_MAX, MAX_BITS, MAX_DIM, MAX_MASK, TOTAL_BITS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v: int) -> Column:
    return F.lit(v).cast("long")


def _shl(c, n) -> Column:
    """shiftleft with a Column shift amount (F.shiftleft takes only ints)."""
    return F.shiftleft(c, n) if isinstance(n, int) else F.call_function("shiftleft", c, n)


def _shr(c, n) -> Column:
    return F.shiftright(c, n) if isinstance(n, int) else F.call_function("shiftright", c, n)


def _shru(c, n) -> Column:
    return F.shiftrightunsigned(c, n) if isinstance(n, int) else F.call_function("shiftrightunsigned", c, n)


def _spread_mask(group: int) -> int:
    """Mask of the 21 axis bits after a spread stage with groups of ``group``
    adjacent bits: bit j sits at (j mod group) + 3 * group * (j div group)."""
    return sum(1 << ((j % group) + MAX_DIM * group * (j // group)) for j in range(MAX_BITS))


AXIS0_BITS = _spread_mask(1)  # bits 0, 3, 6, ..., 60


# ---------------------------------------------------------------------------
# Sums of codes
# ---------------------------------------------------------------------------

_LOW = (1 << 32) - 1


def _joined_halves(high, low) -> Column:
    """Sums of the upper and of the lower 32 bits -> the low 64 bits of the whole; no step can overflow."""
    return _shl(high + _shru(low, 32), 32).bitwiseOR(low.bitwiseAND(_lit(_LOW)))


def code_sum(codes: Column) -> Column:
    """Sum of an array of codes as a bigint. Codes take up to 63 bits, so a few
    of them may pass a bigint: the sum is taken modulo 2**64 (two's
    complement), which is the plain sum wherever that fits."""
    zero = _lit(0)
    return _joined_halves(F.aggregate(codes, zero, lambda a, e: a + _shru(e, 32)),
                          F.aggregate(codes, zero, lambda a, e: a + e.bitwiseAND(_lit(_LOW))))


def sum_of_codes(code) -> Column:
    """The same as an aggregate over rows; sums of codes may be summed again."""
    return _joined_halves(F.sum(_shru(_col(code), 32)), F.sum(_col(code).bitwiseAND(_lit(_LOW))))


# ---------------------------------------------------------------------------
# Whole-table forms
# ---------------------------------------------------------------------------

def _spread_byte(b: int) -> int:
    """Bit j of a byte moved to bit 3j."""
    return sum(((b >> j) & 1) << (MAX_DIM * j) for j in range(8))


# Built by rule: the spread of every byte value.
_BYTE_SPREAD = [_spread_byte(b) for b in range(256)]
# the same table as one SQL array literal: a single parse instead of 256
# separate literal constructions per use
BYTE_SPREAD_SQL = "array(" + ", ".join(f"{t}L" for t in _BYTE_SPREAD) + ")"


def spread_bits(v) -> Column:
    """A 21-bit value with two zero bits inserted between its bits."""
    table = F.expr(BYTE_SPREAD_SQL)
    v = _col(v).cast("long").bitwiseAND(_lit(MAX_MASK))
    parts = [table[_shr(v, 8 * k).bitwiseAND(_lit(255)).cast("int")] for k in range(3)]
    return parts[0].bitwiseOR(_shl(parts[1], 24)).bitwiseOR(_shl(parts[2], 48))


def with_morton(df: DataFrame, x, y, z, out: str = "mortonCode") -> DataFrame:
    """Append ``out`` = Morton code of integer cells (x, y, z)."""
    return df.withColumn(out, morton_code(x, y, z))


def with_decoded(df: DataFrame, code, out=("cx", "cy", "cz")) -> DataFrame:
    """Append the three 21-bit axis cells of a Morton code."""
    return df.withColumns({o: decode_axis(code, d) for d, o in enumerate(out)})


# ---------------------------------------------------------------------------
# Single-column forms (linear, composable)
# ---------------------------------------------------------------------------

def morton_code(x, y, z) -> Column:
    """Morton code of integer cells (x, y, z) as one Column."""
    return (spread_bits(x)
            .bitwiseOR(_shl(spread_bits(y), 1))
            .bitwiseOR(_shl(spread_bits(z), 2)))


def decode_axis(code, dim: int) -> Column:
    """Cell of axis ``dim`` (0, 1, 2) of a Morton code as one int Column."""
    if dim not in (0, 1, 2):
        raise ValueError(f"invalid dimension {dim}: valid dimensions are 0, 1, 2")
    c = _col(code)
    terms = [
        F.shiftleft(F.shiftright(c, MAX_DIM * i + dim).bitwiseAND(_lit(1)), i)
        for i in range(MAX_BITS)
    ]
    return reduce(lambda acc, t: acc.bitwiseOR(t), terms).cast("int")


def block_code(code, resolution: int) -> Column:
    """Octree ancestor code: drop 3 * resolution low bits (unsigned shift)."""
    return F.shiftrightunsigned(_col(code), MAX_DIM * resolution)


# ---------------------------------------------------------------------------
# Prefixes, boxes and relations on codes
# ---------------------------------------------------------------------------

def common_prefix(lo, hi) -> Column:
    """struct(prefix, bits): the shared prefix of two codes in whole 3-bit
    steps, low bits zeroed, and how many of the 63 bits are shared. Equal codes
    share all 63 bits."""
    lo, hi = _col(lo), _col(hi)
    xor = lo.bitwiseXOR(hi)
    width = F.length(F.bin(xor))  # index of the highest differing bit + 1
    shift = F.when(xor == 0, F.lit(0)).otherwise(
        F.least(F.floor((width + 2) / 3).cast("int") * 3, F.lit(TOTAL_BITS)))
    return F.struct(
        lo.bitwiseAND(_shl(_lit(LONG_MAX), shift)).alias("prefix"),
        (F.lit(TOTAL_BITS) - shift).alias("bits"),
    )


def depth_limit(common_bits) -> Column:
    """Octree search depth below the common prefix: 7, 6 or 5 levels."""
    b = _col(common_bits)
    out = None
    for below, levels in DEPTH_LIMITS:
        out = F.when(b < below, levels) if out is None else out.when(b < below, levels)
    return out.otherwise(DEPTH_LIMIT_DEFAULT)


def code_in_box(code, box_min, box_max) -> Column:
    """Per-axis inclusive test of a code against the box spanned by two codes.
    The bits of an axis keep its order where they stand: nothing is decoded."""
    axis = lambda c, d: _col(c).bitwiseAND(_lit(AXIS0_BITS << d))
    return reduce(lambda a, b: a & b, [
        axis(code, d).between(axis(box_min, d), axis(box_max, d)) for d in range(MAX_DIM)
    ])


def code_midpoint(a, b) -> Column:
    """Code of the per-axis integer average of two codes."""
    mids = [F.floor((decode_axis(a, d) + decode_axis(b, d)) / 2) for d in range(MAX_DIM)]
    return morton_code(*mids)


def range_contains(lo, hi, code) -> Column:
    """Index-space containment of a code in [lo, hi]."""
    return _col(code).between(_col(lo), _col(hi))


def range_contains_range(lo, hi, other_lo, other_hi) -> Column:
    return range_contains(lo, hi, other_lo) & range_contains(lo, hi, other_hi)


def range_overlaps(lo, hi, other_lo, other_hi) -> Column:
    """Index-space overlap of two inclusive ranges (symmetric form: also true
    when the other range encloses this one)."""
    return (_col(lo) <= _col(other_hi)) & (_col(other_lo) <= _col(hi))


def range_overlaps_compat(lo, hi, other_lo, other_hi) -> Column:
    """The original overlap test: true when either end of the other range
    lies in this one. It misses another range that strictly encloses this
    one; kept for compatibility, ``range_overlaps`` is the symmetric form."""
    return range_contains(lo, hi, other_lo) | range_contains(lo, hi, other_hi)


def range_contains_in_user_space(lo, hi, other_lo, other_hi) -> Column:
    """Both corners of the other range lie inside this range's box per axis."""
    return code_in_box(other_lo, lo, hi) & code_in_box(other_hi, lo, hi)


def range_overlaps_in_user_space(lo, hi, other_lo, other_hi) -> Column:
    """The two boxes overlap on all three axes."""
    return reduce(lambda a, b: a & b, [
        F.greatest(decode_axis(lo, d), decode_axis(other_lo, d))
        <= F.least(decode_axis(hi, d), decode_axis(other_hi, d))
        for d in range(MAX_DIM)
    ])


def bigmin_litmax(xd, rmin, rmax) -> Column:
    """struct(litmax, bigmin) for a code ``xd`` outside the box [rmin, rmax]:
    the largest in-box code below xd and the smallest in-box code above it,
    0 when there is none. One native fold over the bits (the
    Tropf-Herzog division), with no Python in the loop, from the highest bit
    in which the three codes differ: above it no step changes anything.

    Callers that read both fields should bind the result to a column first:
    each use of an unbound expression runs the fold again.
    """
    xd, rmin, rmax = _col(xd), _col(rmin), _col(rmax)

    def bit(v, i):
        return _shr(v, i).bitwiseAND(_lit(1))

    def step(acc, i):
        zmin, zmax, big, lit, done = acc["zmin"], acc["zmax"], acc["bigmin"], acc["litmax"], acc["done"]
        bits = F.floor(i / 3).cast("int") + 1
        dim = i - (bits - 1) * 3
        # the low ``bits`` cells of axis ``dim``, in interleaved positions
        m = _shl(_shru(_lit(AXIS0_BITS), F.lit(TOTAL_BITS) - bits * 3), dim)
        top = _shl(_lit(1), i)
        keep = F.bitwise_not(m)
        load_over_min = zmin.bitwiseAND(keep).bitwiseOR(top)
        load_under_max = zmax.bitwiseAND(keep).bitwiseOR(m.bitwiseXOR(top))
        bx, bmin, bmax = bit(xd, i), bit(zmin, i), bit(zmax, i)
        live = ~done
        c001 = live & (bx == 0) & (bmin == 0) & (bmax == 1)
        c011 = live & (bx == 0) & (bmin == 1) & (bmax == 1)
        c100 = live & (bx == 1) & (bmin == 0) & (bmax == 0)
        c101 = live & (bx == 1) & (bmin == 0) & (bmax == 1)
        return F.struct(
            F.when(c101, load_over_min).otherwise(zmin).alias("zmin"),
            F.when(c001, load_under_max).otherwise(zmax).alias("zmax"),
            F.when(c001, load_over_min).when(c011, zmin).otherwise(big).alias("bigmin"),
            F.when(c101, load_under_max).when(c100, zmax).otherwise(lit).alias("litmax"),
            (done | c011 | c100).alias("done"),
        )

    start = F.struct(
        rmin.cast("long").alias("zmin"), rmax.cast("long").alias("zmax"),
        _lit(0).alias("bigmin"), _lit(0).alias("litmax"), F.lit(False).alias("done"),
    )
    differ = xd.bitwiseXOR(rmin).bitwiseOR(xd.bitwiseXOR(rmax)).bitwiseAND(_lit(LONG_MAX))
    first = F.coalesce(F.length(F.bin(differ)), F.lit(TOTAL_BITS)) - 1
    return F.aggregate(F.sequence(first, F.lit(0), F.lit(-1)), start, step,
                       lambda acc: F.struct(acc["litmax"].alias("litmax"), acc["bigmin"].alias("bigmin")))
