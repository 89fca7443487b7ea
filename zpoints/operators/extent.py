"""Extent, quantisation and encoding of point tables.

The extent is a global aggregate (partial, then final: one row). Its six
numbers are fetched and enter the encoding as literals, which fold into
constants; nothing else reaches the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zpoints.functions.zcode import block_code, with_morton
from zpoints.schema import MAX_MASK, PRECISION, RESOLUTION, precision_factor

AXES = ("x", "y", "z")
EXTENT_COLUMNS = ["minX", "minY", "minZ", "maxX", "maxY", "maxZ"]


def extent(points: DataFrame, x="x", y="y", z="z") -> DataFrame:
    """One row: minX, minY, minZ, maxX, maxY, maxZ (partial + final agg)."""
    cols = [F.col(c) for c in (x, y, z)]
    return points.agg(
        *[F.min(c).alias(f"min{a.upper()}") for c, a in zip(cols, AXES)],
        *[F.max(c).alias(f"max{a.upper()}") for c, a in zip(cols, AXES)],
    )


def extent_literal(values: Mapping[str, float] | Sequence[float], spark) -> DataFrame:
    """A known extent (e.g. from a catalog) as the same one-row table."""
    if not isinstance(values, Mapping):
        values = dict(zip(EXTENT_COLUMNS, values))
    return spark.createDataFrame([tuple(float(values[c]) for c in EXTENT_COLUMNS)],
                                 ", ".join(f"{c} double" for c in EXTENT_COLUMNS))


def extent_normalized(ext: DataFrame, precision: float = PRECISION, compat: bool = False,
                      suffix: str = "") -> DataFrame:
    """Add the integer size of the extent per axis (sizeX, sizeY, sizeZ, with ``suffix``).

    ``compat=True`` truncates the size to whole units before scaling, losing
    the fraction (e.g. 2.9 units -> 2000 cells); the default rounds the scaled
    size instead (2900 cells).
    """
    f = precision_factor(precision)
    sizes = {}
    for a in AXES:
        span = F.col(f"max{a.upper()}") - F.col(f"min{a.upper()}")
        if compat:
            sizes[f"size{a.upper()}{suffix}"] = span.cast("long") * f
        else:
            sizes[f"size{a.upper()}{suffix}"] = F.round(span * f).cast("long")
    return ext.withColumns(sizes)


def one_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a struct Column (a scalar subquery)."""
    return df.select(F.struct(*df.columns).alias("v")).scalar()


def extent_values(points_or_extent: DataFrame) -> dict:
    """The extent as six Python floats.

    Accepts points (aggregated here) or an extent row. The result of a
    global aggregate is one row, so this is a bounded fetch; the values then
    enter plans as literals, which fold into constants and keep predicates
    on computed codes small.
    """
    df = points_or_extent
    if not set(EXTENT_COLUMNS) <= set(df.columns):
        df = extent(df)
    row = df.select(*EXTENT_COLUMNS).first()
    if row is None or any(row[c] is None for c in EXTENT_COLUMNS):
        raise ValueError("cannot quantise an empty point set (the extent is undefined)")
    return {c: float(row[c]) for c in EXTENT_COLUMNS}


def check_fits(ext: Mapping[str, float], precision: float = PRECISION) -> None:
    """Raise when the quantised extent does not fit 21 bits per axis (codes
    would wrap silently)."""
    f = precision_factor(precision)
    for a in AXES:
        span = round((ext[f"max{a.upper()}"] - ext[f"min{a.upper()}"]) * f)
        if span > MAX_MASK:
            raise ValueError(f"extent along {a} spans {span} cells at precision {precision}; "
                             f"the code holds {MAX_MASK}: coarsen the precision or split the cloud")


def normalize_coords(points: DataFrame, ext: Mapping[str, float] | DataFrame | None = None,
                     precision: float = PRECISION, check: bool = True, outside: str = "raise") -> DataFrame:
    """Quantise: normX = round((x - minX) * f) as bigint, f = 1 / precision.

    ``ext`` is the extent (a mapping of the six values, or a one-row extent
    table); it is computed from ``points`` when omitted. Against a given
    extent, cells outside the code space (below 0 or above 21 bits) would wrap
    when encoded. ``outside`` says what becomes of such points: "raise" fails
    the job; "flag" adds a boolean column ``outside`` and nulls their cells,
    so they can be routed to a quarantine; "wrap" keeps the original
    behaviour.
    """
    given = ext is not None and not isinstance(ext, DataFrame)
    if ext is None or isinstance(ext, DataFrame):
        ext = extent_values(points if ext is None else ext)
    if check:
        check_fits(ext, precision)
    f = precision_factor(precision)
    names = [f"norm{a.upper()}" for a in AXES]
    out = points.withColumns({n: F.round((F.col(a) - F.lit(ext[f"min{a.upper()}"])) * f).cast("long")
                              for n, a in zip(names, AXES)})
    if outside == "wrap" or (outside == "raise" and not given):
        return out  # an extent of these very points holds them all
    bad = reduce(lambda a, b: a | b, [~F.col(n).between(0, MAX_MASK) for n in names])
    if outside == "flag":
        out = out.withColumn("outside", F.coalesce(bad, F.lit(False)))
        return out.withColumns({n: F.when(~F.col("outside"), F.col(n)) for n in names})
    if outside != "raise":
        raise ValueError(f"outside must be raise, flag or wrap, not {outside!r}")
    return out.withColumn(names[0], F.when(bad, F.raise_error(
        F.lit("point outside the extent's 21-bit cell space"))).otherwise(F.col(names[0])))


def split_outside(points: DataFrame, ext: Mapping[str, float], precision: float = PRECISION,
                  resolution: int = RESOLUTION) -> tuple[DataFrame, DataFrame]:
    """(coded points inside the extent's cell space, quarantined points with their original columns)."""
    flagged = normalize_coords(points, ext, precision, outside="flag")
    inside = flagged.filter(~F.col("outside")).drop("outside")
    return (_coded(inside, resolution, keep_cells=False),
            flagged.filter(F.col("outside")).select(*points.columns))


def encode_points(points: DataFrame, ext: Mapping[str, float] | DataFrame | None = None,
                  precision: float = PRECISION,
                  resolution: int = RESOLUTION, keep_cells: bool = False) -> DataFrame:
    """Flat points -> coded points: quantise, Morton-encode, block code.

    Output columns: x, y, z, mortonCode, blockMortonCode, intensity,
    classification, red, green, blue (plus normX/Y/Z with ``keep_cells``).
    Any other input columns are carried along.
    """
    return _coded(normalize_coords(points, ext, precision), resolution, keep_cells)


def _coded(cells: DataFrame, resolution: int, keep_cells: bool) -> DataFrame:
    coded = with_morton(cells, "normX", "normY", "normZ", out="mortonCode")
    coded = coded.withColumn("blockMortonCode", block_code("mortonCode", resolution))
    if not keep_cells:
        coded = coded.drop("normX", "normY", "normZ")
    first = ["x", "y", "z", "mortonCode", "blockMortonCode"]
    rest = [c for c in coded.columns if c not in first]
    return coded.select(*first, *rest)


def scale_points(points: DataFrame, scale: Mapping[str, float] | float = PRECISION,
                 classification: int = 1) -> DataFrame:
    """Fixed-point scaling: X = trunc(x * (1 / scale_x)) as int per axis.

    Classification is set to 1 ("unclassified"). ``scale`` may be one factor
    for all axes or one per axis.
    """
    if not isinstance(scale, Mapping):
        scale = {a: scale for a in AXES}
    cols = {a.upper(): (F.col(a) * (1 / scale[a])).cast("int") for a in AXES}
    others = [c for c in points.columns if c not in AXES and c != "classification"]
    return points.select(
        *[cols[a.upper()].alias(a.upper()) for a in AXES],
        F.lit(classification).cast("byte").alias("classification"),
        *others,
    )


def scaled_codes(scaled: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """Integer points -> translated to their minimum, coded and blocked.

    The integer minimum and maximum are a one-row aggregate, fetched; a span
    past 21 bits raises (its codes would wrap).
    """
    m = scaled.agg(*[F.min(a.upper()).alias(f"min{a.upper()}") for a in AXES],
                   *[F.max(a.upper()).alias(f"max{a.upper()}") for a in AXES]).first()  # one row
    for a in (a.upper() for a in AXES):
        if m[f"min{a}"] is not None and m[f"max{a}"] - m[f"min{a}"] > MAX_MASK:
            raise ValueError(f"scaled {a} spans {m[f'max{a}'] - m[f'min{a}']} cells; the code holds {MAX_MASK}")
    t = scaled.withColumns({f"t{a.upper()}": F.col(a.upper()) - F.lit(m[f"min{a.upper()}"]) for a in AXES})
    t = with_morton(t, "tX", "tY", "tZ", out="mortonCode")
    return t.withColumn("blockMortonCode", block_code("mortonCode", resolution))


def scale_points_by_catalog(points: DataFrame, catalog: DataFrame, cloud_id: str, classification: int = 1) -> DataFrame:
    """Fixed-point scaling with each cloud's own factors: ``catalog`` has
    (id, scaleX, scaleY, scaleZ), and ``points[cloud_id]`` names the cloud.
    The catalog has one row per cloud; AQE broadcasts it when it is small.
    A point whose cloud is null or not in the catalog fails the job."""
    scales = catalog.select(F.col("id").alias("__id"), "scaleX", "scaleY", "scaleZ")
    j = points.join(scales, F.col(cloud_id) == F.col("__id"), "left")
    unknown = F.raise_error(F.concat(F.lit("no scale factors for cloud "), F.coalesce(F.col(cloud_id).cast("string"), F.lit("null"))))
    factor = lambda a: F.when(F.col("__id").isNull(), unknown).otherwise(F.col(f"scale{a.upper()}"))
    others = [c for c in points.columns if c not in AXES and c != "classification"]
    return j.select(*[(F.col(a) * (1 / factor(a))).cast("int").alias(a.upper()) for a in AXES],
                    F.lit(classification).cast("byte").alias("classification"), *others)
