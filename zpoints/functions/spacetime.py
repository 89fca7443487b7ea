"""Space-time Z-codes for event tables: (lon, lat, seconds in week) -> code.

Longitude and latitude are mapped to 21-bit cells, time in the week to 20
bits, by ceil of the scaled value; the inverse is linear (so it is not exact,
because of the ceil).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zpoints.functions.zcode import _col, with_decoded, with_morton
from zpoints.schema import MAX_MASK

# Cells per axis and the time span of the curve.
LON_PREC = (1 << 21) - 1
LAT_PREC = (1 << 21) - 1
T_PREC = (1 << 20) - 1
T_MAX = float(7 * 24 * 3600)  # seconds in a week


def norm_lon(x) -> Column:
    return F.ceil((F.lit(180.0) + _col(x)) / 360.0 * LON_PREC).cast("int")


def norm_lat(y) -> Column:
    return F.ceil((F.lit(90.0) + _col(y)) / 180.0 * LAT_PREC).cast("int")


def norm_t(t) -> Column:
    return F.greatest(F.lit(0), F.ceil(_col(t) / T_MAX * T_PREC).cast("int"))


def denorm_lon(x) -> Column:
    return (_col(x) / F.lit(float(LON_PREC))) * 360.0 - 180.0


def denorm_lat(y) -> Column:
    return (_col(y) / F.lit(float(LAT_PREC))) * 180.0 - 90.0


def denorm_t(t) -> Column:
    return (_col(t) * T_MAX / F.lit(float(T_PREC))).cast("long")


def st_index(events: DataFrame, lon="lon", lat="lat", t="t", out="stCode") -> DataFrame:
    """Append the space-time code (and the three normalised cells). An event
    outside the curve's domain (cells outside 21 bits) fails the job: its code would wrap."""
    df = events.withColumns({"nLon": norm_lon(lon), "nLat": norm_lat(lat), "nT": norm_t(t)})
    bad = ~(F.col("nLon").between(0, LON_PREC) & F.col("nLat").between(0, LAT_PREC) & F.col("nT").between(0, MAX_MASK))
    df = df.withColumn("nLon", F.when(bad, F.raise_error(F.lit("event outside the space-time domain")))
                       .otherwise(F.col("nLon")))
    return with_morton(df, "nLon", "nLat", "nT", out=out)


def st_invert(coded: DataFrame, code="stCode") -> DataFrame:
    """Append (lonInv, latInv, tInv) decoded from the space-time code."""
    df = with_decoded(coded, code, out=("__a", "__b", "__c"))
    return df.withColumns({
        "lonInv": denorm_lon("__a"), "latInv": denorm_lat("__b"), "tInv": denorm_t("__c"),
    }).drop("__a", "__b", "__c")


def st_box_cells(lon_range, lat_range, t_range):
    """Cells of a space-time box (driver side: six numbers), clamped to the
    domain. Normalisation is monotone, so every event inside the box has cells
    inside these."""
    import math

    def nl(v):
        return min(max(0, int(math.ceil((180.0 + v) / 360.0 * LON_PREC))), LON_PREC)

    def nb(v):
        return min(max(0, int(math.ceil((90.0 + v) / 180.0 * LAT_PREC))), LAT_PREC)

    def nt(v):
        return min(max(0, int(math.ceil(v / T_MAX * T_PREC))), MAX_MASK)
    lo = (nl(lon_range[0]), nb(lat_range[0]), nt(t_range[0]))
    hi = (nl(lon_range[1]), nb(lat_range[1]), nt(t_range[1]))
    return lo, hi


def st_ranges(spark, lon_range, lat_range, t_range):
    """Z ranges (lo, hi) covering a space-time box, as a DataFrame."""
    from zpoints.plans.cover import box_table, zranges
    lo, hi = st_box_cells(lon_range, lat_range, t_range)
    return zranges(box_table(spark, [(0, *lo, *hi)])).drop("box_id")


def st_box_filter(events: DataFrame, lon_range, lat_range, t_range, lon="lon", lat="lat", t="t",
                  code_col: str = "stCode") -> DataFrame:
    """Events inside a space-time box: the exact test on the raw values. On a
    stored table with the code column, the box's code ranges are pushed to
    the scan first (files and row groups outside them are skipped)."""
    from zpoints.operators.clip import any_of, frontier_ranges
    if code_col in events.columns:
        ranges = frontier_ranges(st_box_cells(lon_range, lat_range, t_range))
        events = events.filter(any_of(F.col(code_col).between(lo, hi) for lo, hi in ranges))
    return events.filter(F.col(lon).between(*lon_range) & F.col(lat).between(*lat_range)
                         & F.col(t).between(*t_range))


def _wrapped(lo: float, hi: float, first: float, period: float) -> list[tuple[float, float]]:
    """The inclusive interval lo..hi of a circle as one or two intervals of [first, first + period).

    ``lo > hi`` means that the interval runs across the seam; ends outside the
    base period are taken modulo the period. An interval as long as the period is all of it.
    """
    if lo > hi:
        hi += period * -(-(lo - hi) // period)
    if hi - lo >= period:
        return [(first, first + period)]
    turns = (lo - first) // period
    lo, hi = lo - turns * period, hi - turns * period
    end = first + period
    if hi >= end:
        return [(lo, end), (first, hi - period)]
    return [(lo, hi), (end, end)] if lo == first else [(lo, hi)]  # the seam is one place at both ends of the domain


def st_periodic_boxes(lon_range, lat_range, t_range) -> list[tuple]:
    """A box on the circle of longitudes and the circle of the week -> one to four boxes (lon, lat, t) of the plain domain.

    Longitude 180 is longitude -180 and the end of the week its start; the
    boxes of one answer meet only there. Latitude is no circle: an inverted range raises.
    """
    if lat_range[0] > lat_range[1]:
        raise ValueError(f"inverted latitudes: {lat_range}")
    return [(lon, tuple(lat_range), t) for lon in _wrapped(*lon_range, -180.0, 360.0) for t in _wrapped(*t_range, 0, int(T_MAX))]


def st_periodic_filter(events: DataFrame, lon_range, lat_range, t_range, lon="lon", lat="lat", t="t",
                       code_col: str = "stCode") -> DataFrame:
    """Events inside a space-time box that may run across the antimeridian and the end of the week.

    The up to four boxes are alternatives of one filter, so no event comes
    twice. On a stored table their code ranges, taken together and reduced to
    32, are pushed to the scan.
    """
    from zpoints.operators.clip import any_of, coarsen, frontier_ranges, merged
    boxes = st_periodic_boxes(lon_range, lat_range, t_range)
    if code_col in events.columns:
        ranges = coarsen(merged(r for b in boxes for r in frontier_ranges(st_box_cells(*b))))
        events = events.filter(any_of(F.col(code_col).between(lo, hi) for lo, hi in ranges))
    return events.filter(any_of(F.col(lon).between(*x) & F.col(lat).between(*y) & F.col(t).between(*z) for x, y, z in boxes))


def write_events(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Events with their code, range-partitioned and sorted by it, so that box filters skip files and row groups."""
    st_index(events).repartitionByRange("stCode").sortWithinPartitions("stCode").write.mode(mode).parquet(path)
