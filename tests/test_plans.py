"""Plan-shape regressions: the physical plans the design relies on."""
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from zpoints import queries as Q
from zpoints import registry as R
from zpoints.operators import blocks as BL
from zpoints.operators import clip as CL
from zpoints.sources import io as IO


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _executed(E.queries()[name](spark, SF_SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_blocks_one_shuffle_with_partial_collect(spark):
    plan = _executed(R.q_blocks_collect(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_collect_list" in plan


def test_stored_clip_is_pushed_down_without_shuffle(spark):
    path = R.scratch_path(spark, "test-plan-blocks")
    IO.write_points_as_blocks(R._coded(spark, SF_SMALL), path)
    stored = IO.read_blocks(spark, path)
    for box in (R.B1, R.B_LARGE, ((256,) * 3, (10495,) * 3)):
        plan = _executed(CL.clip_points(stored, box))
        # the scan gets the OR of code ranges (and the IsNotNull that Spark infers beside it)
        assert re.search(r"PushedFilters: \[(IsNotNull\(blockMortonCode\), )?Or\(", plan)
        assert "Exchange" not in plan and "Join" not in plan


def test_ingest_has_one_exchange_and_files_do_not_overlap(spark):
    from pyspark.sql import functions as F
    coded = R._coded(spark, SF_SMALL)
    assert _executed(IO.gather_in_place(coded)).split("Initial Plan")[0].count("Exchange ") == 1
    path = R.scratch_path(spark, "test-files")
    IO.write_points_as_blocks(R._coded(spark, SF_SMALL), path)
    spans = sorted((r.lo, r.hi) for r in IO.read_blocks(spark, path).groupBy(F.input_file_name()).agg(
        F.min("blockMortonCode").alias("lo"), F.max("blockMortonCode").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_range_join_reads_the_points_once(spark):
    df = R.q_clip_many_boxes(spark, SF_SMALL)
    plan = _executed(df).split("Initial Plan")[0]
    assert plan.count("lineitem.parquet") == 1


def test_box_filters_without_joins(spark):
    for q in (R.q_st_box_filter, R.q_cube_around_point, R.q_extent_normalized):
        assert "Join" not in _executed(q(spark, SF_SMALL))
