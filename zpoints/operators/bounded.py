"""Grouping into arrays without unbounded groups.

``collect_list`` puts a whole group into one task and one row. A block of a
dense scan, or a point with a crowded neighbourhood, can hold a large share
of all rows, so groups above ``max_per_row`` are split into parts:

1. count rows per key (partial aggregation, so a hot key costs one row per
   map task) and keep only keys above the cap. There are at most
   ``total_rows / max_per_row`` of them: that is the size bound of the hot
   key table, and it is also checked at run time before broadcasting it;
2. rows of ordinary keys get part 0. Rows of a hot key are spread over
   buckets by a hash of the whole row and numbered inside their bucket in the
   order of the whole row; every ``max_per_row`` of them are a part. Both
   follow from the rows alone (equal rows are interchangeable), so a retried
   task gives the same parts, and no part exceeds the cap;
3. group by (key, part) - one shuffle.

Keys are matched null-safely, so a null key is split like any other. No row is
dropped; readers treat all parts of a key as one group.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MAX_PER_ROW = 1 << 20


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], renamed: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[r]) for k, r in zip(keys, renamed)])


def hot_keys(df: DataFrame, keys: Sequence[str], max_per_row: int) -> DataFrame:
    """(keys, __buckets) of the keys with more than ``max_per_row`` rows.
    Reads the key columns only; at most total_rows / max_per_row rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_per_row)
              .select(*keys, F.ceil(F.col("__n") / max_per_row).cast("int").alias("__buckets")))


def with_parts(df: DataFrame, keys: Sequence[str], max_per_row: int = DEFAULT_MAX_PER_ROW,
               part_col: str = "part") -> DataFrame:
    """Add ``part_col``: 0 for keys with at most ``max_per_row`` rows; for the
    others a number such that no (key, part) holds more than ``max_per_row`` rows."""
    parted = hot_parts(df, keys, max_per_row, part_col)
    return df.withColumn(part_col, F.lit(0)) if parted is None else parted


def hot_parts(df: DataFrame, keys: Sequence[str], max_per_row: int = DEFAULT_MAX_PER_ROW,
              part_col: str = "part") -> DataFrame | None:
    """``with_parts``, or None if no key is hot (then no part column is needed to group by)."""
    keys = list(keys)
    hot = hot_keys(df, keys, max_per_row)
    if hot.isEmpty():  # one job over the key columns
        return None
    names = [f"__k{i}" for i in range(len(keys))]
    hot = hot.withColumnsRenamed(dict(zip(keys, names)))
    marked = df.join(hot, same_keys(df, hot, keys, names), "left").drop(*names)
    cold = marked.filter(F.col("__buckets").isNull()).drop("__buckets").withColumn(part_col, F.lit(0))
    row = [F.col(c) for c in df.columns]
    spread = marked.filter(F.col("__buckets").isNotNull()).withColumn(
        "__bucket", F.pmod(F.xxhash64(*row), F.col("__buckets").cast("long")).cast("int"))
    nth = F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy(*row)) - 1
    spread = spread.withColumn("__nth", nth).withColumn(
        part_col, (F.col("__bucket") + F.col("__buckets") * F.floor(F.col("__nth") / max_per_row)).cast("int"))
    return cold.unionByName(spread.drop("__buckets", "__bucket", "__nth"))


def collect_bounded(df: DataFrame, keys: Sequence[str], value: Column, out: str,
                    max_per_row: int = DEFAULT_MAX_PER_ROW, sort: bool = True,
                    part_col: str = "part") -> DataFrame:
    """groupBy(keys, part) -> array of ``value``, sorted when ``sort``.

    One row per key (part 0) unless the key holds more than ``max_per_row``
    rows; then it spans several rows of at most that many, with different parts.
    """
    keys = list(keys)
    parted = with_parts(df, keys, max_per_row, part_col)
    agg = F.collect_list(value)
    if sort:
        agg = F.array_sort(agg)
    return parted.groupBy(*keys, part_col).agg(agg.alias(out))
