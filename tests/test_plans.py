"""Guards on the physical plans."""

import re

import pytest

from tidemark.registry import QUERIES

STREAMS = {n for n in QUERIES if n.startswith(("stream_", "target_"))} | {"ingest", "sink_append", "synth_from_schema", "tree_walk"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # a window after a single-partition exchange would put a table in one task;
    # only the table of block totals, at most one row per block, may do so
    for window in re.finditer(r"(Window \[.*)\n.*Sort .*\n.*Exchange SinglePartition", plan):
        assert "sum(_total" in window.group(1), plan


def test_range_scan_is_pushed(spark, sf_dir):
    plan = plan_of(QUERIES["scan_incremental"](spark, sf_dir))
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_column_pruning(spark, sf_dir):
    plan = plan_of(QUERIES["select_fields"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "user_id", "value"}


def test_day_filter_reaches_scan(spark, sf_dir):
    plan = plan_of(QUERIES["inclusive_days"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in plan
