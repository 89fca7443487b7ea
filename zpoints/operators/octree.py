"""Linear adaptive octree: leaves that hold at most ``cap`` points, and files cut along them.

A fixed block resolution gives crowded blocks where a scan is dense and many
nearly empty ones where it is sparse. Here an octant is a leaf if it holds at
most ``cap`` points and its parent holds more (or is the root); octants at the
floor resolution are not split further and may hold more.

Leaves are built bottom-up. Points are counted per floor octant (partial
counts, so one row per octant and map task meets the shuffle). Level by
level, the at most eight children of an octant are grouped: a sum within the
cap makes one open octant of them; otherwise the open children are leaves and
the parent goes on as split, which every ancestor then is. Leaves travel
along unchanged, so the whole tree is one chain of aggregations over
ever fewer rows, with no second reading.

``write_octree_store`` packs consecutive leaves into files of about ``target``
points: file borders are octant borders, files cover disjoint code intervals,
and sizes are near equal however skewed the cloud is. A task writes a run of
consecutive files, each into a folder of its own (``file=N``), so the tasks, and
what each sends to the driver, follow the points and not the files. A point
finds its task by the broadcast code intervals of the tasks (a task has
half a million points, so there are few), is shuffled there, once, and finds
its file among the files' first codes, which are sorted in with the points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zpoints.functions.zcode import _shl, block_code
from zpoints.operators.blocks import POINT_FIELDS, point_struct
from zpoints.operators.bounded import DEFAULT_MAX_PER_ROW
from zpoints.operators.clip import range_join
from zpoints.plans.cover import _ones
from zpoints.schema import MAX_BITS, MAX_DIM, RESOLUTION
from zpoints.session import checkpoint_dir

OPEN, SPLIT, LEAF = 0, 1, 2
TASK_POINTS = 1 << 19  # points that a writing task holds, whole files at least


def octree_leaves(coded: DataFrame, cap: int, floor: int = RESOLUTION, code_col: str = "mortonCode") -> DataFrame:
    """(level, code, lo, hi, n_points): the leaves. ``code`` is the octant's code at its level (cells of
    ``2**level`` a side), lo..hi the point codes it spans. Points with a null code are in no leaf."""
    if cap < 1 or not 0 <= floor <= MAX_BITS:
        raise ValueError("cap must be positive and floor between 0 and 21")
    tree = (coded.where(F.col(code_col).isNotNull()).groupBy(block_code(code_col, floor).alias("code"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(floor).alias("level"), "code", "n", F.when(F.col("n") <= cap, OPEN).otherwise(SPLIT).alias("state")))
    # an overfull octant at the floor cannot be split: it is a leaf, and the parent is split
    tree = tree.selectExpr("level", "code", "n", f"explode(IF(state = {SPLIT}, array({SPLIT}, {LEAF}), array({OPEN}))) AS state")
    for level in range(floor, MAX_BITS):
        # open and split octants meet their siblings at the parent; leaves keep a key of their own
        member = "struct(level, code, n, state)"
        grouped = (tree.selectExpr(f"{member} AS o", f"IF(state = {LEAF}, struct(level, code), struct({level + 1} AS level, "
                                   f"shiftright(code, {MAX_DIM}) AS code)) AS key", f"state = {LEAF} AS done")
                   .groupBy("key", "done").agg(F.collect_list("o").alias("members"), F.sum("o.n").alias("total"))
                   .withColumn("members", F.expr(f"IF(done, members, filter(members, m -> m.state = {OPEN}))")))
        parent = lambda state: f"struct({level + 1} AS level, key.code AS code, total AS n, {state} AS state)"
        tree = grouped.selectExpr(
            f"inline(CASE WHEN done THEN members WHEN total <= {cap} THEN array({parent(OPEN)}) ELSE concat("
            f"transform(members, m -> struct(m.level AS level, m.code AS code, m.n AS n, {LEAF} AS state)), "
            f"array({parent(SPLIT)})) END)")
    shift = F.col("level") * MAX_DIM
    return (tree.where(F.col("state") != SPLIT)
            .withColumn("lo", _shl(F.col("code"), shift))
            .select("level", "code", "lo", F.col("lo").bitwiseOR(_ones(shift)).alias("hi"), F.col("n").alias("n_points")))


def packed_leaves(leaves: DataFrame, target: int) -> DataFrame:
    """Leaves with ``file``: consecutive leaves in code order, a new file whenever the points before a leaf pass a multiple of ``target``.

    The running sum is taken in two steps: inside each sorted partition, and
    over the partitions' totals (one number each) on the driver.
    """
    spark = leaves.sparkSession
    checkpoint_dir(spark)
    dealt = (leaves.repartitionByRange("lo").sortWithinPartitions("lo")
             .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True))
    before, starts = 0, []
    for r in dealt.groupBy("__pid").agg(F.sum("n_points").alias("n"), F.min("lo").alias("lo")).orderBy("lo").collect():
        starts.append((r["__pid"], before))
        before += r["n"]
    offsets = F.broadcast(spark.createDataFrame(starts, "__pid int, __before long"))  # a row per partition
    inside = F.sum("n_points").over(Window.partitionBy("__pid").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.join(offsets, "__pid")
            .withColumn("file", F.floor((F.col("__before") + F.coalesce(inside, F.lit(0))) / target).cast("int"))
            .drop("__pid", "__before"))


def octree_files(leaves: DataFrame, target: int) -> DataFrame:
    """(file, lo, hi, n_points): the code interval and the points of every file; numbers are gapless from 0."""
    files = (packed_leaves(leaves, target).groupBy("file")
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n_points").alias("n_points")))
    # as many rows as output files; a leaf larger than the target skips numbers
    return files.withColumn("file", F.row_number().over(Window.orderBy("lo")) - 1)


def dealt_points(coded: DataFrame, files: DataFrame, tasks: int, n_files: int) -> DataFrame:
    """Points with the ``file`` that holds them, partitioned by ``__task``: equal runs of files to a task. One shuffle of
    the points, none before it; points with a null code are in no file."""
    own = ["mortonCode", "blockMortonCode", "x", "y", "z", *POINT_FIELDS]
    run = files.select(F.expr(f"CAST(CAST(file AS BIGINT) * {tasks} DIV {n_files} AS INT)").alias("__task"), "file", "lo", "hi")
    spans = run.groupBy("__task").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    points = range_join(coded.select(*own), spans, "mortonCode", broadcast=True).select("__task", *own)
    starts = run.select("__task", F.col("lo").alias("mortonCode"), F.col("file").alias("__start"))
    dealt = points.unionByName(starts, allowMissingColumns=True).repartitionById(tasks, "__task")
    so_far = (Window.partitionBy("__task").orderBy("mortonCode", F.col("__start").isNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (dealt.withColumn("file", F.last("__start", ignorenulls=True).over(so_far))
            .where(F.col("__start").isNull()).drop("__start"))


def write_octree_store(coded: DataFrame, path: str, target: int, cap: int | None = None, floor: int = RESOLUTION,
                       max_points_per_row: int = DEFAULT_MAX_PER_ROW, mode: str = "errorifexists") -> DataFrame:
    """Coded points -> blocks in files along octree leaves; returns the file table (file, lo, hi, n_points).

    Every file holds between ``target - cap`` and ``target + cap`` points,
    unless a floor octant alone holds more or it is the last (``cap``: an eighth of the target by default). Points
    are dealt to the task that writes their file; they are shuffled once. A block of more than ``max_points_per_row``
    points in a file is several rows (parts).
    """
    spark = coded.sparkSession
    checkpoint_dir(spark)
    files = octree_files(octree_leaves(coded, cap or max(1, target // 8), floor), target).checkpoint(eager=True)
    found = files.agg(F.count("*").alias("files"), F.sum("n_points").alias("points"), F.max("n_points").alias("most")).first()
    if not found["files"]:
        raise ValueError("no points to store")
    tasks = min(found["files"], max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found["points"] // TASK_POINTS)))
    keys = ["file", "blockMortonCode"]
    part = F.lit(0)
    if found["most"] > max_points_per_row:  # rows are numbered where they are: a file is one task's
        nth = F.row_number().over(Window.partitionBy("__task", *keys).orderBy(point_struct())) - 1
        part = F.floor(nth / max_points_per_row).cast("int")
    # a block may cross a file border where leaves are smaller than blocks: its points are grouped per file
    blocks = (dealt_points(coded, files, tasks, found["files"]).withColumn("part", part)
              .groupBy("__task", *keys, "part").agg(F.array_sort(F.collect_list(point_struct())).alias("points")))
    (blocks.sortWithinPartitions(*keys, "part").select("file", "blockMortonCode", "part", "points")
           .write.mode(mode).partitionBy("file").parquet(path))
    return files


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(lo, hi, n_points) of the point codes in every file of a blocks store, as read back from it."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.inline("points"))
    return rows.groupBy("file").agg(F.min("mortonCode").alias("lo"), F.max("mortonCode").alias("hi"),
                                    F.count("*").alias("n_points")).drop("file")
