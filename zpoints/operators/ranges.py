"""Range tables: merging, cutting and chunk pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zpoints.functions.zcode import bigmin_litmax, code_in_box
from zpoints.plans.cover import coalesce_ranges as coalesce_ranges_per_group  # noqa: F401


def _local_islands(groups: list):
    """Per partition of ranges sorted by (groups, lo): merged islands, in order. The
    island still open at the end of an Arrow batch is carried into the next.
    A closure, shipped by value: workers need only pandas, not zpoints."""
    def run(it):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext
        pid, nth, rest = TaskContext.get().partitionId(), 0, None

        def islands(pdf):
            seg = np.ones(len(pdf), bool)
            if len(pdf) > 1 and groups:
                g = pdf[groups]
                same = (g.eq(g.shift()) | (g.isna() & g.shift().isna())).all(axis=1).to_numpy()
                seg[1:] = ~same[1:]
            elif len(pdf) > 1:
                seg[1:] = False
            reach = pdf["hi"].groupby(np.cumsum(seg)).cummax().to_numpy()
            lo = pdf["lo"].to_numpy()
            new = seg.copy()
            new[1:] |= (lo[1:] > reach[:-1]) & (lo[1:] - 1 > reach[:-1])  # lo > reach first: no underflow
            out = pdf.loc[new].copy()
            last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pdf) - 1]])
            out["hi"] = reach[last]
            return out

        for pdf in it:
            if len(pdf):
                found = islands(pdf.reset_index(drop=True) if rest is None else pd.concat([rest, pdf], ignore_index=True))
                done, rest = found.iloc[:-1], found.iloc[-1:]
                if len(done):
                    yield done.assign(pid=np.int32(pid), nth=np.arange(nth, nth + len(done)))
                    nth += len(done)
        if rest is not None:
            yield rest.assign(pid=np.int32(pid), nth=np.int64(nth))
    return run


def _without_copies():
    """Equal rows of an Arrow batch become one, so a range that a large share of all rows repeats costs the
    shuffle a row per batch."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            one = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([])
            yield from one.select(batch.schema.names).to_batches()
    return run


def coalesce_ranges(ranges: DataFrame, groups=("box_id",), lo: str = "lo", hi: str = "hi",
                    num_partitions: int | None = None) -> DataFrame:
    """Merge overlapping or adjacent inclusive ranges per group, with no
    group ever handled by a single task.

    Ranges are range-partitioned over (group, lo), so a hot group is split
    across tasks, and merged into islands inside each sorted partition (one
    shuffle of the ranges, whose copies are dropped before it). Only an island that reaches past its partition's end can touch a
    later one. The last island of every partition - one row per partition -
    is fetched; walking over them in order gives the island open at the start
    of each partition, and the islands that it reaches are joined to it.

    Any lo <= hi of bigint is accepted, the top code included; an inverted range or a
    null end raises. Null group values are a group.
    """
    from zpoints.session import checkpoint_dir
    groups = list(groups)
    spark = ranges.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bad = F.col(lo).isNull() | F.col(hi).isNull() | (F.col(lo) > F.col(hi))
    checked = ranges.select(*groups, F.when(bad, F.raise_error(F.lit("range ends must not be null, nor min exceed max")))
                            .otherwise(F.col(lo).cast("long")).alias("lo"), F.col(hi).cast("long").alias("hi"))
    checked = checked.mapInArrow(_without_copies(), checked.schema)
    ordered = checked.repartitionByRange(n, *groups, "lo", "hi").sortWithinPartitions(*groups, "lo", "hi")
    gschema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in ordered.schema.fields if f.name in groups)
    islands = ordered.mapInPandas(_local_islands(groups),
                                  f"{gschema}lo long, hi long, pid int, nth long").checkpoint(eager=True)
    lasts = (islands.groupBy("pid").agg(F.max_by(F.struct(*groups, "lo", "hi"), "nth").alias("x"))
             .select("pid", "x.*").collect())  # one row per partition
    carried, open_island = [], None  # (pid, group values, lo and hi of the island open at its start)
    for r in sorted(lasts, key=lambda r: r["pid"]):
        group = tuple(r[g] for g in groups)
        if open_island is not None:
            carried.append((r["pid"], *open_island))
        if open_island is not None and open_island[:-2] == group and r["lo"] - 1 <= open_island[-1]:
            open_island = (*group, open_island[-2], max(open_island[-1], r["hi"]))
        else:
            open_island = (*group, r["lo"], r["hi"])
    names = [f"__g{i}" for i in range(len(groups))]
    kinds = {f.name: f.dataType.simpleString() for f in islands.schema.fields}
    table = spark.createDataFrame(carried, ", ".join(
        ["__pid int", *[f"{c} {kinds[g]}" for c, g in zip(names, groups)], "__lo long", "__hi long"]))
    joined = islands.join(F.broadcast(table), F.col("pid") == F.col("__pid"), "left")  # a row per partition
    reached = F.col("__hi").isNotNull() & ((F.col("lo") <= F.col("__hi")) | (F.col("lo") - 1 == F.col("__hi")))
    for g, c in zip(groups, names):
        reached = reached & F.col(g).eqNullSafe(F.col(c))
    start = F.when(reached, F.col("__lo")).otherwise(F.col("lo"))
    return (joined.withColumn("__start", start).groupBy(*groups, "__start").agg(F.max("hi").alias(hi))
                  .withColumnRenamed("__start", lo).select(*groups, lo, hi))


def range_length(lo="lo", hi="hi"):
    """hi - lo + 1 as bigint (no truncation to int)."""
    return F.col(hi) - F.col(lo) + 1


def cut_ranges(ranges: DataFrame, pivot: str = "pivot", lo: str = "lo", hi: str = "hi",
               in_range: str | None = None, compat: bool = True) -> DataFrame:
    """Split each range (a box in user space) at a pivot code.

    * a single-code range yields nothing;
    * a pivot inside the box: [lo, pivot-1] and [pivot+1, hi]; with the pivot
      at an end, the compat form yields only the other end point (the
      original behaviour), otherwise the remaining interior;
    * a pivot outside the box: [lo, LITMAX] and [BIGMIN, hi].

    ``in_range`` names a boolean column; by default it is computed as the
    pivot's per-axis containment in the box. Output: the input columns plus
    ``piece`` (0, 1) and ``cut_lo``, ``cut_hi``.
    """
    l, h, p = F.col(lo), F.col(hi), F.col(pivot)
    # bound to columns: the division is run once a range, and only where the pivot is outside
    bound = ranges.withColumn("__in", F.col(in_range) if in_range else code_in_box(p, l, h))
    inside, div = F.col("__in"), F.col("__div")
    bound = bound.withColumn("__div", F.when((l == h) | inside, F.lit(None)).otherwise(bigmin_litmax(p, l, h)))

    def rng(a, b):
        return F.struct(a.alias("cut_lo"), b.alias("cut_hi"))
    at_lo = rng(h, h) if compat else rng(l + 1, h)
    at_hi = rng(l, l) if compat else rng(l, h - 1)
    pieces = (F.when(l == h, F.array().cast("array<struct<cut_lo:bigint,cut_hi:bigint>>"))
               .when(inside & (p == l), F.array(at_lo))
               .when(inside & (p == h), F.array(at_hi))
               .when(inside, F.array(rng(l, p - 1), rng(p + 1, h)))
               .otherwise(F.array(rng(l, div["litmax"]), rng(div["bigmin"], h))))
    return bound.select("*", F.posexplode(pieces).alias("piece", "__r")).select(
        *ranges.columns, "piece", F.col("__r.cut_lo").alias("cut_lo"), F.col("__r.cut_hi").alias("cut_hi"))


def _last_event(groups: list):
    """Per partition of sorted events: its last event, and the end of the last range of the same group, if there is one."""
    def run(it):
        import pandas as pd
        from pyspark import TaskContext
        last, reach = None, None
        for pdf in it:
            if not len(pdf):
                continue
            end = pdf.iloc[-1]
            same = pdf[groups].apply(lambda c: c.eq(end[c.name]) | (c.isna() & pd.isna(end[c.name]))).all(axis=1) if groups else pd.Series(
                True, pdf.index)
            if last is not None and not all((last[g] == end[g]) or (pd.isna(last[g]) and pd.isna(end[g])) for g in groups):
                reach = None
            opened = pdf["hi"][same & pdf["hi"].notna()]
            reach = int(opened.iloc[-1]) if len(opened) else reach
            last = end
        if last is not None:
            yield pd.DataFrame([[*(last[g] for g in groups), int(last["cursor"]), reach, TaskContext.get().partitionId()]],
                               columns=[*groups, "cursor", "hi", "pid"]).astype({"cursor": "Int64", "hi": "Int64"})
    return run


def _pieces_between(groups: list, carried: dict, last_pid: int):
    """Per partition of sorted events: what is left of the open range after each event, up to the next one.
    ``carried``: pid -> (group values, cursor, end) of the event before the partition."""
    def run(it):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        columns = [*groups, "cursor", "hi", "pivot"]
        before = carried.get(pid)
        rest = None if before is None else pd.DataFrame([[*before, False]], columns=columns)

        def sweep(pdf, close):
            seg = np.ones(len(pdf), bool)
            if len(pdf) > 1:
                g = pdf[groups]
                same = (g.eq(g.shift()) | (g.isna() & g.shift().isna())).all(axis=1).to_numpy() if groups else np.ones(len(pdf), bool)
                seg[1:] = ~same[1:]
            reach = pdf["hi"].astype("Int64").groupby(np.cumsum(seg)).ffill()
            cursor = pdf["cursor"].to_numpy(np.int64)
            end = reach.fillna(-1).to_numpy(np.int64)  # no open range: nothing is left
            cut = np.zeros(len(pdf), bool)  # the next event is a pivot inside the open range
            cut[:-1] = ~seg[1:] & pdf["pivot"].to_numpy(bool)[1:] & (cursor[1:] - 1 <= end[:-1])
            stop = end.copy()
            stop[:-1][cut[:-1]] = cursor[1:][cut[:-1]] - 2
            found = pdf[groups].assign(lo=cursor, hi=stop)[reach.notna().to_numpy() & (cursor <= stop)]
            keep = pdf.iloc[-1:].assign(hi=reach.iloc[-1:], pivot=False)
            return (found if close else found[found.index < len(pdf) - 1]), keep

        for pdf in it:
            if len(pdf):
                pdf = pdf[columns]
                out, rest = sweep(pdf.reset_index(drop=True) if rest is None else pd.concat([rest, pdf], ignore_index=True), False)
                yield out
        if rest is not None and pid == last_pid:
            yield sweep(rest.reset_index(drop=True), True)[0]
    return run


def subtract_pivots(ranges: DataFrame, pivots: DataFrame, groups=("box_id",), pivot: str = "pivot", lo: str = "lo",
                    hi: str = "hi", num_partitions: int | None = None) -> DataFrame:
    """Ranges of each group without the pivot codes of the same group: (groups, lo, hi), sorted out in one ordered sweep.

    The opposite of ``coalesce_ranges``, which is applied to the ranges first.
    Range starts and pivots are range-partitioned by (group, code) together,
    so a range with any number of pivots inside it is spread over tasks and is never
    one row's array. Within a sorted partition, what is left between an event
    and the next follows from the two; across partitions only the last event
    matters, and one row per partition is fetched for it. Pivots outside all ranges, repeated ones
    and null ones change nothing. Codes are non-negative.
    """
    from zpoints.session import checkpoint_dir
    groups = list(groups)
    spark = ranges.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("long")
    starts = coalesce_ranges(ranges, groups, lo, hi, n).select(*groups, F.col(lo).alias("cursor"), F.col(hi).alias("hi"),
                                                               F.lit(False).alias("pivot"), F.col(lo).alias("at"))
    cuts = pivots.where(F.col(pivot).isNotNull()).select(*groups, (F.col(pivot).cast("long") + 1).alias("cursor"), none.alias("hi"),
                                                         F.lit(True).alias("pivot"), F.col(pivot).cast("long").alias("at"))
    order = [*groups, "at", "pivot"]  # at equal codes the range opens before the pivot cuts it
    events = (starts.unionByName(cuts).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .select(*groups, "cursor", "hi", "pivot"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in events.schema.fields if f.name in groups)
    # a checkpoint keeps the partitions as they are: the second pass reads the same ones
    events = events.checkpoint(eager=True)
    carried, last, last_pid = {}, None, -1
    ends = events.mapInPandas(_last_event(groups), f"{kinds}cursor long, hi long, pid int").collect()  # a row per partition
    for r in sorted(ends, key=lambda r: r["pid"]):
        group = tuple(r[g] for g in groups)
        if last is not None:
            carried[r["pid"]] = last
        reach = r["hi"] if r["hi"] is not None else (last[-1] if last is not None and last[:-2] == group else None)
        last, last_pid = (*group, r["cursor"], reach), r["pid"]
    return events.mapInPandas(_pieces_between(groups, carried, last_pid), f"{kinds}lo long, hi long").withColumnsRenamed(
        {"lo": lo, "hi": hi})


def chunk_prune(chunks: DataFrame, boxes: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Pairs (chunk, box) where the chunk (a lo..hi code interval, e.g. a file
    or row group) may hold a code of the box (zmin, zmax codes spanning the
    box per axis).

    Candidates are pairs whose intervals overlap in index space, found with
    two binned range joins (chunk start inside the box span; box start inside
    the chunk), never a cross join. Each candidate is then tested exactly: it
    is kept iff the chunk's first code is inside the box, or the smallest
    in-box code above it (BIGMIN) exists and is at most its last code.
    Single-cell boxes need only the overlap.
    """
    from zpoints.operators.clip import range_join
    spans = boxes.select("*", F.col("zmin").alias("lo"), F.col("zmax").alias("hi"))
    ch = chunks.withColumnsRenamed({lo: "__clo", hi: "__chi"}) if (lo, hi) != ("__clo", "__chi") else chunks
    # (a) the chunk starts inside the box span
    a = range_join(ch, spans, "__clo").drop("lo", "hi")
    # (b) the box span starts inside the chunk, after the chunk's first code
    ch_ranges = ch.select("*", F.col("__clo").alias("lo"), F.col("__chi").alias("hi"))
    b = (range_join(boxes, ch_ranges, "zmin").drop("lo", "hi")
         .filter(F.col("__clo") < F.col("zmin")))
    pairs = a.unionByName(b)
    l, zmin, zmax = F.col("__clo"), F.col("zmin"), F.col("zmax")
    first_in = code_in_box(l, zmin, zmax)
    big = bigmin_litmax(l, zmin, zmax)["bigmin"]
    keep = F.when(zmin == zmax, F.lit(True)).otherwise(first_in | ((big != 0) & (big <= F.col("__chi"))))
    return pairs.filter(keep).withColumnsRenamed({"__clo": lo, "__chi": hi})
