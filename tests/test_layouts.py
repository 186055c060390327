"""Layouts: dense grid (AGG-9), clustered partitioned Gold (SNK-9), targeted salting (LAY-1)."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tripstream.operators.skew import heavy_keys, salted_layout
from tripstream.operators.windows import volume_by_sliding_window, volume_grid
from tripstream.streaming import catalog as C

T0 = dt.datetime(2024, 1, 1)


def test_grid_is_dense_and_sums_to_the_volume(spark, monkeypatch):
    from tripstream.operators import windows

    monkeypatch.setattr(windows, "GRID_CHUNK", 3)
    rows = [(T0, 1), (T0, 1), (T0 + dt.timedelta(hours=2), 2), (T0 + dt.timedelta(hours=2), 99), (T0 + dt.timedelta(hours=1), None), (None, 1)]
    vol = volume_by_sliding_window(spark.createDataFrame(rows, "ts timestamp_ntz, zone int"), "ts", "zone", "30 minutes", "15 minutes")
    zones = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "id int")
    got = volume_grid(vol, zones, "zone", "id", "15 minutes").collect()
    starts = sorted({r.window_start for r in got})
    assert starts[0] == T0 - dt.timedelta(minutes=15) and starts[-1] == T0 + dt.timedelta(hours=2)
    assert all(b - a == dt.timedelta(minutes=15) for a, b in zip(starts, starts[1:]))
    assert len(got) == len(starts) * 4 and {r.zone for r in got} == {1, 2, 3, None}
    assert all(r.window_end - r.window_start == dt.timedelta(minutes=30) for r in got)
    assert sum(r.trip_volume for r in got) == vol.agg(F.sum("trip_volume")).first()[0] == 10
    assert {(r.window_start, r.zone): r.trip_volume for r in got}[(T0, 1)] == 2


def test_grid_without_trips(spark):
    vol = volume_by_sliding_window(spark.createDataFrame([], "ts timestamp_ntz, zone int"), "ts", "zone")
    assert volume_grid(vol, spark.createDataFrame([(1,)], "id int"), "zone", "id", "15 minutes").count() == 0


def test_grid_has_the_cells_of_the_matrix(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/events.parquet")
    vol = volume_by_sliding_window(e, "ts", "event_type")
    grid = E.queries()["heatmap_grid_events"](spark, sf_small)
    assert grid.where("trip_volume > 0").exceptAll(vol.select(grid.columns)).count() == 0
    assert grid.agg(F.sum("trip_volume")).first()[0] == vol.agg(F.sum("trip_volume")).first()[0]


def test_one_file_per_directory_and_slice_and_pruning(spark, sf_small):
    path = C.gold_events_layout(spark, sf_small)
    local = path.replace("file:", "")
    files = Counter(os.path.dirname(os.path.join(d, f)) for d, _, names in os.walk(local) for f in names if f.endswith(".parquet"))
    days = Counter(os.path.dirname(x) for x in files)
    assert len(days) > 20 and max(files.values()) <= C.SLICES
    # a day that no slice bound cuts has one file in each of its directories
    assert sum(n == 1 for n in files.values()) > 0.8 * len(files)
    one = spark.read.parquet(path).where((F.col("date") == "2024-01-05") & (F.col("event_type") == "view"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and one.select(F.input_file_name()).distinct().count() <= C.SLICES
    assert one.count() > 0


@pytest.mark.parametrize("hot", ["hot", None])
def test_salted_layout_balances_a_hot_key(spark, hot):
    n, parts = 30_000, 12
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), (F.col("id") % 701).cast("string"))).alias("k"),
                                 F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id")).alias("v"))
    total, heavy = heavy_keys(rows, "k", 1 / (2 * parts))
    assert total == n and [(k, c) for k, c in heavy] == [(hot, n // 3)]
    laid = salted_layout(rows, "k", parts).withColumn("p", F.spark_partition_id())
    sizes = sorted(r["count"] for r in laid.groupBy("p").count().collect())
    assert len(sizes) >= parts - 1 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert laid.drop("p").exceptAll(rows).count() == 0 and rows.exceptAll(laid.drop("p")).count() == 0
    # only the hot key is in several ranges
    spread = {r["k"]: r["n"] for r in laid.groupBy("k").agg(F.count_distinct("p").alias("n")).collect()}
    assert spread.pop(hot) > 1 and set(spread.values()) == {1}


def test_salted_layout_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert salted_layout(df, "k", 4).count() == 0


def test_pivot_refuses_more_zones_than_columns(spark, sf_small):
    old = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            E.queries()["heatmap_pivot"](spark, sf_small)
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", old)
