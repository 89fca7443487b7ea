"""A range set as streaming state: ranges arrive in a stream, the set per group stays merged.

A batch merge (``operators.ranges.coalesce_ranges``) reads all ranges again
whenever new ones come. Here new ranges are inserted into a set that a
streaming query keeps as state; earlier input is never read again, and the
set survives a restart with the query's checkpoint.

A group may hold any number of ranges, so it must not be one state. Codes are
cut into digits of 16 bits: a range leaves a piece in the bucket (the codes
that share all but the last digit) of each end, and the whole buckets between
them are a range of bucket numbers one tier up, where the same is done again.
So a range becomes at most two pieces on each of four tiers, whatever its
length, and a state, keyed by (group, tier, bucket), holds runs among 65,536
offsets: at most 32,768 of them. A crowded group is spread over its buckets.

Each micro-batch writes the states that it changed, whole, into its own
``batch_id=N`` folder with overwrite; a replayed batch replaces its output. A
reader takes the latest row of every state and merges the pieces.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zpoints.operators.ranges import coalesce_ranges

DIGIT = 16
TIERS = 4  # 4 * 16 bits hold the 63 bits of a code
TOP = (1 << DIGIT) - 1


def range_pieces(ranges: DataFrame, groups: Sequence[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(groups, tier, bucket, a, b): the pieces of every inclusive range of non-negative codes; a null, negative or inverted one raises."""
    bad = F.col(lo).isNull() | F.col(hi).isNull() | (F.col(lo) > F.col(hi)) | (F.col(lo) < 0)
    df = ranges.select(*groups, F.when(bad, F.raise_error(F.lit("ranges must have 0 <= min <= max")))
                       .otherwise(F.col(lo).cast("long")).alias("__lo0"), F.col(hi).cast("long").alias("__hi0"))
    pieces = []
    for t in range(TIERS):
        l, h = f"__lo{t}", f"__hi{t}"
        first, last = f"shiftright({l}, {DIGIT})", f"shiftright({h}, {DIGIT})"
        a, b = f"CAST({l} & {TOP} AS INT)", f"CAST({h} & {TOP} AS INT)"
        piece = lambda bucket, a, b, t=t: f"struct({t} AS tier, {bucket} AS bucket, {a} AS a, {b} AS b)"
        pieces.append(
            f"CASE WHEN {l} IS NULL THEN array() WHEN {first} = {last} THEN array({piece(first, a, b)}) ELSE concat("
            f"IF({a} > 0, array({piece(first, a, TOP)}), array()), IF({b} < {TOP}, array({piece(last, 0, b)}), array())) END")
        # the whole buckets between the ends are a range of the next tier
        up_l, up_h = f"{first} + IF({a} > 0, 1, 0)", f"{last} - IF({b} < {TOP}, 1, 0)"
        between = f"{first} < {last} AND {up_l} <= {up_h}"
        df = df.selectExpr("*", f"IF({between}, {up_l}, NULL) AS __lo{t + 1}", f"IF({between}, {up_h}, NULL) AS __hi{t + 1}")
    return df.selectExpr(*[f"`{g}`" for g in groups], f"inline(concat({', '.join(pieces)}))")


def _insert(columns: list):
    """State update of one (group, tier, bucket): its runs with the batch's pieces merged in, emitted if they changed.
    A closure, shipped by value: workers need only numpy and pandas."""
    def run(key, batches, state):
        import numpy as np
        import pandas as pd
        old = np.frombuffer(state.get[0], "<u2").astype(np.int64).reshape(-1, 2) if state.exists else np.zeros((0, 2), np.int64)
        runs = old
        for pdf in batches:
            new = pdf[["a", "b"]].to_numpy(np.int64)
            every = np.concatenate([runs, new])
            every = every[np.lexsort((every[:, 1], every[:, 0]))]
            reach = np.maximum.accumulate(every[:, 1])
            start = np.concatenate([[True], every[1:, 0] > reach[:-1] + 1])
            last = np.concatenate([np.flatnonzero(start)[1:] - 1, [len(every) - 1]])
            runs = np.column_stack([every[start, 0], reach[last]])
        if len(runs) != len(old) or (runs != old).any():
            packed = runs.astype("<u2").tobytes()
            state.update((packed,))
            yield pd.DataFrame([[*key, packed]], columns=columns)
    return run


def insert_ranges(stream: DataFrame, groups: Sequence[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """The streaming set: (groups, tier, bucket, runs) of every state that a micro-batch changes, in update mode.
    ``runs`` are little-endian unsigned 16-bit pairs (first, last offset)."""
    keys = [*groups, "tier", "bucket"]
    pieces = range_pieces(stream, groups, lo, hi)
    out = T.StructType([*[pieces.schema[k] for k in keys], T.StructField("runs", T.BinaryType())])
    return pieces.groupBy(*keys).applyInPandasWithState(
        _insert(out.names), out, "runs binary", "update", "NoTimeout")


def start_range_set(stream: DataFrame, groups: Sequence[str], out_path: str, checkpoint_location: str,
                    lo: str = "lo", hi: str = "hi", available_now: bool = False):
    """Start the query that inserts a stream of ranges into the set stored at ``out_path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = (insert_ranges(stream, groups, lo, hi).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint_location))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_range_set(spark: SparkSession, out_path: str, groups: Sequence[str]) -> DataFrame:
    """(groups, lo, hi): the merged set. Reads the latest row of each state, never the ranges that were inserted."""
    keys = [*groups, "tier", "bucket"]
    latest = spark.read.parquet(out_path).groupBy(*keys).agg(F.max_by("runs", "batch_id").alias("runs"))
    runs = latest.mapInPandas(_unpacked(list(groups)), T.StructType(
        [*[latest.schema[g] for g in groups], T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))
    return coalesce_ranges(runs, groups=list(groups))


def _unpacked(groups: list):
    digit = DIGIT

    def run(it):
        import numpy as np
        import pandas as pd
        for pdf in it:
            runs = [np.frombuffer(r, "<u2").astype(np.int64).reshape(-1, 2) for r in pdf["runs"]]
            n = [len(r) for r in runs]
            every = np.concatenate(runs) if runs else np.zeros((0, 2), np.int64)
            rows = pdf[groups].loc[pdf.index.repeat(n)].reset_index(drop=True)
            base = np.repeat(pdf["bucket"].to_numpy(np.int64) << digit, n)
            shift = np.repeat(pdf["tier"].to_numpy(np.int64) * digit, n)
            rows["lo"] = (base + every[:, 0]) << shift
            rows["hi"] = ((base + every[:, 1]) << shift) + ((np.int64(1) << shift) - 1)
            yield rows
    return run
