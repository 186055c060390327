"""Replay (SRT-2, SET-1, PRJ-10) and the keyed upsert sink (SNK-6..8, STR-13)."""

from tripstream.operators.replay import cut_batches, global_index, impute_zone_ids, zone_pool
from tripstream.session import work_path
from tripstream.sinks.tables import exactly_once_audit
from tripstream.sinks.upsert import KeyedUpsertTable


def _ordered(spark, n):
    return spark.createDataFrame([(i, (i * 7919) % n) for i in range(n)], "id long, t long")


def test_global_index_is_sort_position(spark):
    df = _ordered(spark, 1001)
    got = {r.id: r.row_index for r in global_index(df, ["t", "id"], parts=7).collect()}
    want = {i: pos for pos, (i, _) in enumerate(sorted([(i, (i * 7919) % 1001) for i in range(1001)], key=lambda x: (x[1], x[0])))}
    assert got == want


def test_short_tail_is_kept(spark):
    df = _ordered(spark, 1001)
    keep = cut_batches(df, ["t", "id"], 500)
    assert sorted(r["count"] for r in keep.groupBy("batch_no").count().collect()) == [1, 500, 500]


def test_zone_pool_fallbacks(spark):
    z = spark.createDataFrame([(5,), (None,), (7,)], "LocationID int")
    assert sorted(r.location_id for r in zone_pool(spark, zones=z).collect()) == [5, 7]
    t = spark.createDataFrame([(1, None), (None, 3)], "PULocationID int, DOLocationID int")
    empty = spark.createDataFrame([], "LocationID int")
    assert sorted(r.location_id for r in zone_pool(spark, zones=empty, trips=t).collect()) == [1, 3]
    assert zone_pool(spark).count() == 263


def test_impute_is_deterministic_and_from_pool(spark):
    rows = [(1, f"2024-01-01 10:00:{i:02d}", "x", None if i % 2 else 4, None) for i in range(40)]
    df = spark.createDataFrame(rows, "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID int, DOLocationID int")
    pool = spark.createDataFrame([(10,), (20,), (30,)], "location_id int")
    a = impute_zone_ids(df, pool).orderBy("tpep_pickup_datetime").collect()
    b = impute_zone_ids(df.repartition(5), pool).orderBy("tpep_pickup_datetime").collect()
    assert a == b
    assert all(r.PULocationID in (4, 10, 20, 30) and r.DOLocationID in (10, 20, 30) for r in a)
    assert all(r.PULocationID == 4 for r, src in zip(a, rows) if src[3] == 4)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, fare double, note string")


def test_upsert_idempotent_update_insert(spark):
    t = KeyedUpsertTable(spark, work_path(spark, "upsert"), ["trip_id"])
    assert t.read() is None
    assert t.upsert(_batch(spark, [("a", 1.0, "n0"), ("b", 2.0, "n0")]), 0)
    assert t.upsert(_batch(spark, [("a", 1.0, "n0"), ("b", 2.0, "n0")]), 0)  # replay of batch 0
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 1.0, "n0"), ("b", 2.0, "n0")]
    # batch 1 updates a, inserts c; two source rows with one key: a single, repeatable pick
    t.upsert(_batch(spark, [("a", 9.0, "n1"), ("c", 3.0, "n1"), ("c", 4.0, "n1")]), 1)
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 9.0, "n1"), ("b", 2.0, "n0"), ("c", 3.0, "n1")]
    assert t.versions().count() == 4
    assert not t.upsert(_batch(spark, []), 2)  # empty batch: nothing written
    assert t.versions(2) is None and t.versions(1).count() == 2


def test_upsert_table_of_empty_batches_only(spark):
    t = KeyedUpsertTable(spark, work_path(spark, "upsert"), ["trip_id"])
    assert not t.upsert(_batch(spark, []), 0)
    assert t.read() is None


def test_audit_counts_missing_and_extra(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    tab = spark.createDataFrame([(1, "a"), (1, "a"), (3, None)], "id int, v string")
    r = exactly_once_audit(src, tab).first()
    assert (r.source_rows, r.table_rows, r.missing_rows, r.extra_rows) == (3, 3, 1, 1)
