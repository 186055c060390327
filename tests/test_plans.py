"""Plan-shape checks behind the scale claims in the README."""

import datetime as dt

import pytest

import __spark_entry__ as E
from tripstream.operators.anomaly import rolling_fare_stats
from tripstream.operators.dedup import dedup_first
from tripstream.operators.matching import interval_join
from tripstream.plans.catalog import BATCH_QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_cartesian_or_nested_loop(spark, sf_small, name):
    p = plan(E.queries()[name](spark, sf_small))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_no_python_udf_in_batch_plans(spark, sf_small):
    for name, fn in BATCH_QUERIES.items():
        p = plan(fn(spark, sf_small))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_dedup_combines_map_side(spark):
    df = spark.createDataFrame([(1, 2, 3)] * 10, "k int, t int, v int")
    assert "partial_min" in plan(dedup_first(df, ["k"], ["t"]))


def test_interval_join_keys_include_time_bucket(spark):
    p = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "pickup_id long, k string, pickup_ts timestamp_ntz")
    d = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "dropoff_id long, k string, dropoff_ts timestamp_ntz")
    s = plan(interval_join(p, d, "k", "pickup_ts", "dropoff_ts", 0, 3600))
    join_lines = [ln for ln in s.splitlines() if "Join" in ln]
    assert join_lines and all("_bk" in ln for ln in join_lines)


def test_trailing_frame_partitioned_by_time_bucket(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], "k string, ts timestamp_ntz, v double")
    s = plan(rolling_fare_stats(df, "k", "ts", "v", strategy="halo"))
    assert "hashpartitioning(k#" in s and "_b#" in s.split("hashpartitioning(k#")[1].split(")")[0]


def test_trailing_frame_prefix_windows_stay_inside_ranges(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], "k string, ts timestamp_ntz, v double")
    s = plan(rolling_fare_stats(df, "k", "ts", "v", strategy="prefix"))
    windows = [ln for ln in s.splitlines() if "Window [" in ln and "sum(_n" in ln]
    assert windows and all("_pid" in ln for ln in windows)


def test_zone_dimension_is_broadcast(spark, sf_small):
    s = plan(E.queries()["zone_enrich"](spark, sf_small))
    assert s.count("BroadcastHashJoin") >= 2 and "LeftOuter" in s
