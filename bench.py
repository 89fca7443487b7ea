"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is forced to run in full with the no-op sink (nothing is
collected). Stored-table queries (clip_*) read blocks that the ingest step
wrote; the ingest itself is timed as ``ingest_write``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zpoints import registry as R  # noqa: E402
from zpoints.operators import clip as CL  # noqa: E402
from zpoints.session import get_spark  # noqa: E402
from zpoints.sources import io as IO  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "extent", "block_code", "blocks_collect", "block_occupancy", "zranges_cover", "range_coalesce",
    "clip_many_boxes", "radius_join", "radius_join_codes", "neighbour_lists", "st_box_filter", "chunk_prune",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_spark(CPUS, shuffle_partitions=int(CPUS) * 2, app="zpoints-bench")
    times: dict[str, float] = {}

    # warm-up: JVM, codegen caches, file listing
    run(R.q_extent(spark, SF_DIR))

    for name in HEADLINE:
        t0 = time.time()
        run(R.QUERIES[name](spark, SF_DIR))
        times[name] = round(time.time() - t0, 3)

    # ingest: encode + gather into blocks + range-partitioned parquet write
    t0 = time.time()
    path = R.scratch_path(spark, "bench-blocks")
    IO.write_points_as_blocks(R._coded(spark, SF_DIR), path)
    times["ingest_write"] = round(time.time() - t0, 3)

    stored = IO.read_blocks(spark, path)
    t0 = time.time()
    run(CL.clip_blocks_cells(stored, CL.block_cells(R.B1)))
    times["clip_blocks"] = round(time.time() - t0, 3)
    t0 = time.time()
    run(CL.clip_points(stored, R.B1))
    times["clip_points"] = round(time.time() - t0, 3)

    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf.group(1)) if sf else SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()
