"""Streaming ingest: point files arriving over time -> blocks on storage.

The batch ingest needs the extent before it can quantise, so a stream is
encoded against a fixed extent (a catalog entry, or the extent of a first
static load), just as a cloud with known bounds is. Each micro-batch is
gathered into blocks and written under its own ``batch_id=N`` folder with
overwrite, so a retried batch replaces its own output (idempotent sink);
progress lives in the query's checkpoint location on shared storage.

Blocks from different batches may share a block code: readers treat all rows
of a code (batches and parts) as one block, as they already do for parts.
"""

from __future__ import annotations

from typing import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from zpoints.operators.extent import check_fits, encode_points
from zpoints.schema import BLOCKS, PRECISION, RESOLUTION
from zpoints.sources.io import parse_points_text, write_points_as_blocks


def read_points_text_stream(spark: SparkSession, path: str, lenient: bool = False,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Text point files appearing under ``path`` as a stream of loaded points."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_points_text(reader.load(path), lenient=lenient)


def encode_stream(points: DataFrame, ext: Mapping[str, float], precision: float = PRECISION,
                  resolution: int = RESOLUTION) -> DataFrame:
    """Flat point stream -> coded point stream against a fixed extent."""
    check_fits(ext, precision)
    return encode_points(points, dict(ext), precision, resolution)


def _write_batch_blocks(out_path: str, max_points_per_row: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.DISK_ONLY)  # read once: counted, sampled and shuffled from here
        try:
            write_points_as_blocks(batch, f"{out_path.rstrip('/')}/batch_id={batch_id}", mode="overwrite",
                                   max_points_per_row=max_points_per_row)
        finally:
            batch.unpersist()
    return write


def start_block_ingest(coded: DataFrame, out_path: str, checkpoint_location: str,
                       available_now: bool = False, processing_time: str | None = None,
                       max_points_per_row: int = 1 << 20):
    """Start the streaming query that appends blocks per micro-batch."""
    w = (coded.writeStream.foreachBatch(_write_batch_blocks(out_path, max_points_per_row))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_stream_blocks(spark: SparkSession, out_path: str) -> DataFrame:
    """Blocks written by the streaming ingest (``batch_id`` is a partition
    column, so a reader can prune by batch)."""
    schema = T.StructType([*BLOCKS.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(out_path)
