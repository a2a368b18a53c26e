"""Plan shapes that must hold at any scale, checked on the static plan of
every registered query that does not run jobs while it is built."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from plan_report import SKIP, _single_partition_consumers, plan_text  # noqa: E402

from flowscore.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
PLAN_QUERIES = sorted(n for n in QUERIES if n not in SKIP)

# Running totals: the only single-partition step is the prefix over block
# totals (one row per day / per 1,000 batches), never over raw rows.
BLOCK_PREFIX = {"throughput", "retain_newest_bytes"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas")


@pytest.fixture(scope="module")
def static_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield {n: plan_text(QUERIES[n](spark, SF)) for n in PLAN_QUERIES}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_plan_scales(static_plans, name):
    plan = static_plans[name]
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert not [n for n in PYTHON_NODES if n in plan], "Python evaluation in the plan"
    one_task = [c for c in _single_partition_consumers(plan)
                if c not in ("HashAggregate", "ObjectHashAggregate", "SortAggregate")]
    if name in BLOCK_PREFIX:
        assert set(one_task) <= {"Window", "Sort"}
    else:
        assert one_task == [], f"single-partition step above: {one_task}"
    # no registered query needs the (large) text of documents or pages
    for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", plan):
        assert not re.search(r"(^|,)(text|html):", schema), schema
