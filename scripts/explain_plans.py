"""Print the formatted physical plans of the headline operators.

Usage: python scripts/explain_plans.py [sf_dir] [name ...]
Clip plans are shown against blocks stored as parquet, as they run in use.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zpoints import registry as R  # noqa: E402
from zpoints.operators import blocks as BL  # noqa: E402
from zpoints.operators import clip as CL  # noqa: E402
from zpoints.session import get_spark  # noqa: E402
from zpoints.sources import io as IO  # noqa: E402

DEFAULT = ["blocks_collect", "block_occupancy", "radius_join", "clip_many_boxes", "range_coalesce"]


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or DEFAULT + ["clip_blocks", "clip_points"]
    spark = get_spark()
    stored = None
    for name in names:
        print(f"===== {name}")
        if name in ("clip_blocks", "clip_points"):
            if stored is None:
                path = R.scratch_path(spark, "explain-blocks")
                IO.write_blocks(BL.collect_blocks(R._coded(spark, sf)), path)
                stored = IO.read_blocks(spark, path)
            df = (CL.clip_blocks_cells(stored, CL.block_cells(R.B1)) if name == "clip_blocks"
                  else CL.clip_points(stored, R.B1))
        else:
            df = R.QUERIES[name](spark, sf)
        df.explain("formatted")


if __name__ == "__main__":
    main()
