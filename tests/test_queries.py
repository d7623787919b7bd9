"""Every registered query against its SQL, and against its declared shape."""

import pytest

import __spark_entry__ as entry
import check
from millrace import workload


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


# Pairs of all rows, and rows that leave the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "Scan ExistingRDD")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(workload.all_queries()))
def test_query(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert not [node for node in FORBIDDEN if node in plan_of(df)]
    verdict, detail, _ = check.compare(spark, con, name, sf_dir, df)
    assert verdict in ("ok", "rows"), detail
    assert " vs " not in detail, f"types differ: {detail}"


def test_scans_are_pruned(spark, sf_dir):
    plan = plan_of(entry.queries()["mart_hourly_stream_evolution"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    assert "PushedFilters: [In(event_type, [click,view])]" in plan
    assert "partial_count" in plan
    plan = plan_of(entry.queries()["mart_user_activity_per_state"](spark, sf_dir))
    assert plan.count("ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>") == 3


def test_marks_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry.queries()["incremental_new_rows"](spark, sf_dir))
    assert "GreaterThan(ts,2024-01-1" in plan


def test_partition_filters(spark, sf_dir):
    plan = plan_of(entry.queries()["partitioned_scan"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_first_rows_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["dedupe_first"](spark, sf_dir))
    assert "row_number(), 1, Partial" in plan and plan.count("Exchange ") == 1


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(workload.all_queries()) - set(workload.all_oracles()) == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())
