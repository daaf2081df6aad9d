"""What the plans must show: pruned scans, no early jobs, no raw fact exchange."""

import os

import pytest

from lumenrec.queries import REGISTRY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, column, bounds", [
    ("event_features", "ts", ("GreaterThan", "LessThan")),
    ("order_features", "o_orderdate", ("GreaterThan", "LessThan")),
    ("date_range", "o_orderdate", ("GreaterThan", "LessThan")),
    ("student_tokens", "o_orderdate", ("GreaterThan",)),
])
def test_day_bounds_reach_the_scan(spark, name, column, bounds):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = [x for x in _plan(REGISTRY[name](spark, SF)).split("PushedFilters: ")[1:] if column in x.split("]")[0]]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert pushed
    for b in bounds:
        assert any(b in x.split("]")[0] for x in pushed), pushed


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries are only declared")
    for build in REGISTRY.values():
        build(spark, SF)
    jobs = [j for j in tracker.getJobIdsForGroup("building")
            if "parquet" not in str(tracker.getJobInfo(j))]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    # reading the files' schemas is the only work
    assert all(s is None or s.numTasks == 1 for s in stages)


def test_events_join_their_classes_without_an_exchange(spark):
    plan = _plan(REGISTRY["event_features"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name, most", [("rule_match", 8), ("conflict_free", 15), ("serve_pack", 16), ("recall_parse", 1)])
def test_tables_are_scanned_few_times(spark, name, most):
    assert _plan(REGISTRY[name](spark, SF)).count("FileScan") <= most
