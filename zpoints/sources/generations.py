"""Generations of a blocks store: appended batches, compaction, and readers that never see a mix.

A streaming ingest leaves a block spread over as many files as batches touched
it. Here a store is a folder of data files that are never changed, and a
series of manifests: generation n lists the files that make up the store (with
code interval and rows of each). A new generation is written aside and takes
effect by one rename of its folder; the rename fails if another writer took
the number first. A reader resolves the latest generation once and reads its
files, so it sees the old or the new state whatever is written meanwhile.

``compact`` rewrites only files whose code intervals overlap others, block by
block; the rest are listed again as they are. Files that no generation lists
any more stay until ``vacuum``.

The manifest is a table: overlaps are found by merging its intervals as a
Spark job. The driver holds the list of files of the generation that it reads,
as for any file scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zpoints.operators.blocks import unnest_blocks
from zpoints.operators.bounded import DEFAULT_MAX_PER_ROW
from zpoints.operators.clip import range_join
from zpoints.operators.ranges import coalesce_ranges
from zpoints.schema import BLOCKS
from zpoints.session import checkpoint_dir
from zpoints.sources.io import write_points_as_blocks

MANIFEST = "file string, lo long, hi long, rows long, batch long"  # a row without a file holds the last batch appended


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def generations(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all committed generations, ascending."""
    fs, folder = _fs(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())


def manifest(spark: SparkSession, root: str, generation: int | None = None) -> DataFrame:
    """The manifest of a generation (the latest by default); empty before the first commit."""
    known = generations(spark, root)
    if not known:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{known[-1] if generation is None else generation}")


def _commit(spark: SparkSession, root: str, rows: DataFrame, after: int) -> int:
    """Make ``rows`` the generation that follows ``after``; fails if there is one already."""
    aside = f"{root}/manifests/.{uuid.uuid4().hex}"
    rows.coalesce(1).write.parquet(aside)
    fs, _ = _fs(spark, root)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = spark.sparkContext._gateway.new_array(rename, 1)
    never_over[0] = rename.NONE
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        context.rename(path(aside), path(f"{root}/manifests/{after + 1}"), never_over)
    except Exception as e:
        fs.delete(path(aside), True)
        raise RuntimeError(f"generation {after + 1} of {root} was committed by another writer") from e
    return after + 1


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows of the blocks files in a folder; reads the code column only."""
    rows = spark.read.schema(BLOCKS).parquet(folder).select("blockMortonCode", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(F.min("blockMortonCode").alias("lo"), F.max("blockMortonCode").alias("hi"),
                                    F.count("*").alias("rows")).withColumn("batch", F.lit(None).cast("long"))


def append_points(spark: SparkSession, root: str, coded: DataFrame, batch: int | None = None,
                  max_points_per_row: int = DEFAULT_MAX_PER_ROW) -> int:
    """Add coded points as blocks; returns the generation that holds them.

    With ``batch``, a number that a stream counts up, a batch that is already
    in is left out, also after its files were compacted away.
    """
    known = generations(spark, root)
    after = known[-1] if known else 0
    old = manifest(spark, root, after or None)
    last = old.where("file IS NULL").agg(F.max("batch")).first()[0]
    if batch is not None and last is not None and batch <= last:
        return after
    folder = f"{root}/data/{'points' if batch is None else f'batch-{batch}'}-{uuid.uuid4().hex}"
    write_points_as_blocks(coded, folder, max_points_per_row=max_points_per_row)
    seen = last if batch is None else batch
    mark = spark.createDataFrame([(None, None, None, None, seen)], MANIFEST)
    return _commit(spark, root, old.where("file IS NOT NULL").unionByName(_listed(spark, folder)).unionByName(mark), after)


def read_generation(spark: SparkSession, root: str, generation: int | None = None) -> DataFrame:
    """The blocks of a generation (the latest by default)."""
    files = sorted(r["file"] for r in manifest(spark, root, generation).where("file IS NOT NULL").select("file").collect())
    return spark.read.schema(BLOCKS).parquet(*files) if files else spark.createDataFrame([], BLOCKS)


def overlapping_files(files: DataFrame) -> DataFrame:
    """Of manifest rows, those whose code interval shares a code with another file's."""
    # doubled codes keep intervals apart that only touch: the merge joins neighbours
    doubled = files.select("*", (F.col("lo") * 2).alias("__at"))
    islands = coalesce_ranges(files.select((F.col("lo") * 2).alias("lo"), (F.col("hi") * 2).alias("hi")), groups=[])
    placed = range_join(doubled.withColumnsRenamed({"lo": "__lo", "hi": "__hi"}), islands, "__at")
    crowded = placed.groupBy(F.col("lo").alias("__island")).agg(F.count("*").alias("__n")).where("__n > 1")
    return (placed.join(crowded, placed["lo"] == F.col("__island"), "left_semi").drop("lo", "hi", "__at")
            .withColumnsRenamed({"__lo": "lo", "__hi": "hi"}))


def compact(spark: SparkSession, root: str, max_points_per_row: int = DEFAULT_MAX_PER_ROW) -> int:
    """Rewrite overlapping files so that every (block, part) is one row; returns the generation (the same one if nothing overlaps)."""
    known = generations(spark, root)
    if not known:
        return 0
    now = manifest(spark, root, known[-1])
    files = now.where("file IS NOT NULL")
    checkpoint_dir(spark)
    moved = overlapping_files(files).select("file").checkpoint(eager=True)
    paths = sorted(r["file"] for r in moved.collect())
    if not paths:
        return known[-1]
    folder = f"{root}/data/compacted-{uuid.uuid4().hex}"
    write_points_as_blocks(unnest_blocks(spark.read.schema(BLOCKS).parquet(*paths)), folder, max_points_per_row=max_points_per_row)
    kept = now.join(moved, "file", "left_anti").select(*now.columns)
    return _commit(spark, root, kept.unionByName(_listed(spark, folder)), known[-1])


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` generations and the data files that none of these lists; returns the number of files deleted.

    Only for a store that no one writes to or reads an older generation of.
    """
    known = generations(spark, root)
    if not known:
        return 0
    fs, data = _fs(spark, f"{root}/data")
    path = spark._jvm.org.apache.hadoop.fs.Path
    listed = {path(r["file"]).toUri().getPath() for n in known[-keep:]
              for r in manifest(spark, root, n).where("file IS NOT NULL").select("file").collect()}
    gone, found = 0, fs.listFiles(data, True)
    while found.hasNext():
        p = found.next().getPath()
        if p.toUri().getPath() not in listed:
            gone += p.getName().endswith(".parquet")
            fs.delete(p, False)
    for n in known[:-keep]:
        fs.delete(path(f"{root}/manifests/{n}"), True)
    return gone


def start_generation_ingest(coded: DataFrame, root: str, checkpoint_location: str, available_now: bool = False,
                            max_points_per_row: int = DEFAULT_MAX_PER_ROW):
    """Start the streaming query that appends each micro-batch of coded points as a generation, each batch once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_points(batch.sparkSession, root, batch, batch_id, max_points_per_row)

    w = coded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if available_now else w).start()
