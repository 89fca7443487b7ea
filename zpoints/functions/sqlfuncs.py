"""The point functions as Spark SQL functions, for use in SQL text.

``register(spark)`` creates temporary SQL functions. Their bodies are SQL
expressions that Catalyst inlines into the query, so a call costs what the
expression costs, takes named arguments, and no Python runs on executors:

* ``z_encode(x, y, z)``, ``z_axis(code, dim)``, ``z_block(code, resolution)``;
* ``z_near(x1, y1, z1, x2, y2, z2, radius)``: within a radius;
* ``z_in_box(code, x0, y0, z0, x1, y1, z1)``: whether a code's cell lies in a box;
* ``z_ranges(x0, y0, z0, x1, y1, z1)``: a table function, at most four code
  ranges (lo, hi) that hold the box.

``z_in_box`` is the OR of those ranges and an exact test per axis. With literal
corners the ranges are constants, which Spark pushes to the parquet scan. They
come from dividing the box twice at the highest bit in which the codes of its corners
differ, as closed expressions of the two codes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from zpoints.functions.zcode import AXIS0_BITS, BYTE_SPREAD_SQL
from zpoints.schema import MAX_BITS, MAX_DIM

DIVISIONS = 2


def _spread(v: str) -> str:
    """21 bits of ``v`` with two zero bits between neighbours, byte by byte through the spread table."""
    return "(" + " | ".join(f"shiftleft(get({BYTE_SPREAD_SQL}, CAST(shiftright({v}, {8 * k}) & {m} AS INT)), {24 * k})"
                            for k, m in enumerate((255, 255, 31))) + ")"


def _axis(code: str, dim: str) -> str:
    return "CAST(" + " | ".join(f"shiftleft(shiftright({code}, {MAX_DIM * i} + {dim}) & 1L, {i})" for i in range(MAX_BITS)) + " AS INT)"


CORNERS = "x0 BIGINT, y0 BIGINT, z0 BIGINT, x1 BIGINT, y1 BIGINT, z1 BIGINT"


# the lower bits of the axis in which two codes first differ, and that bit itself
_TOP = "shiftleft(1L, greatest(length(bin(a ^ b)) - 1, 0))"
_BELOW = f"(shiftleft({AXIS0_BITS}L, greatest(length(bin(a ^ b)) - 1, 0) % {MAX_DIM}) & ({_TOP} - 1))"


def statements() -> list[str]:
    """The CREATE statements, in the order of their use of one another."""
    corners = "z_encode(x0, y0, z0), z_encode(x1, y1, z1)"
    exact = " AND ".join(f"z_axis(code, {d}) BETWEEN {v}0 AND {v}1" for d, v in enumerate("xyz"))
    create = "CREATE OR REPLACE TEMPORARY FUNCTION "
    out = [
        create + f"z_spread(v BIGINT) RETURNS BIGINT RETURN {_spread('v')}",
        create + "z_encode(x BIGINT, y BIGINT, z BIGINT) RETURNS BIGINT "
                 "RETURN z_spread(x) | shiftleft(z_spread(y), 1) | shiftleft(z_spread(z), 2)",
        create + f"z_axis(code BIGINT, dim INT) RETURNS INT RETURN {_axis('code', 'dim')}",
        create + f"z_block(code BIGINT, resolution INT) RETURNS BIGINT RETURN shiftrightunsigned(code, {MAX_DIM} * resolution)",
        create + "z_near(x1 DOUBLE, y1 DOUBLE, z1 DOUBLE, x2 DOUBLE, y2 DOUBLE, z2 DOUBLE, radius DOUBLE) RETURNS BOOLEAN "
                 "RETURN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) + (z2 - z1) * (z2 - z1) <= radius * radius",
        create + f"z_litmax(a BIGINT, b BIGINT) RETURNS BIGINT RETURN IF(a = b, b, (b & ~({_BELOW} | {_TOP})) | {_BELOW})",
        create + f"z_bigmin(a BIGINT, b BIGINT) RETURNS BIGINT RETURN IF(a = b, a, (a & ~({_BELOW} | {_TOP})) | {_TOP})",
        create + "z_in_0(code BIGINT, a BIGINT, b BIGINT) RETURNS BOOLEAN RETURN code >= a AND code <= b",
        create + "z_parts_0(a BIGINT, b BIGINT) RETURNS ARRAY<STRUCT<lo: BIGINT, hi: BIGINT>> RETURN array(struct(a AS lo, b AS hi))",
    ]
    for n in range(1, DIVISIONS + 1):  # each division binds its interval once
        out += [
            create + f"z_in_{n}(code BIGINT, a BIGINT, b BIGINT) RETURNS BOOLEAN "
                     f"RETURN z_in_{n - 1}(code, a, z_litmax(a, b)) OR z_in_{n - 1}(code, z_bigmin(a, b), b)",
            create + f"z_parts_{n}(a BIGINT, b BIGINT) RETURNS ARRAY<STRUCT<lo: BIGINT, hi: BIGINT>> "
                     f"RETURN concat(z_parts_{n - 1}(a, z_litmax(a, b)), z_parts_{n - 1}(z_bigmin(a, b), b))",
        ]
    return out + [
        create + f"z_in_box(code BIGINT, {CORNERS}) RETURNS BOOLEAN RETURN z_in_{DIVISIONS}(code, {corners}) AND {exact}",
        create + f"z_ranges({CORNERS}) RETURNS TABLE(lo BIGINT, hi BIGINT) RETURN SELECT DISTINCT r.lo, r.hi "
                 f"FROM (SELECT explode(p) AS r FROM (SELECT z_parts_{DIVISIONS}({corners}) AS p))",
    ]


def register(spark: SparkSession) -> None:
    """Create the functions in the session."""
    for s in statements():
        spark.sql(s)
