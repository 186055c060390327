"""Sources: CSV header binding (SRC-5/6), Parquet with explicit schema (SRC-8), SQL view (SRC-10)."""

import os
import tempfile

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tests.fixtures import ZONE_SCHEMA
from tripstream.sources.tables import read_csv_with_header, read_dimension_csv, read_parquet, sql_over_view

S = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def _csv(text):
    d = tempfile.mkdtemp(prefix="tripstream-csv-")
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write(text)
    return d


def test_dimension_csv_skips_heading(spark):
    p = _csv("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n")
    rows = read_dimension_csv(spark, p, ZONE_SCHEMA).collect()
    assert len(rows) == 1 and rows[0].LocationID == 1


def test_header_mismatch_is_an_error(spark):
    p = _csv("b,a\nx,1\n")
    with pytest.raises(Exception):
        read_csv_with_header(spark, p, S).collect()
    ok = _csv("a,b\n1,x\n")
    assert read_csv_with_header(spark, ok, S).first().b == "x"


def test_parquet_explicit_schema_missing_column_is_null(spark, sf_small):
    sch = StructType([StructField("r_regionkey", IntegerType()), StructField("no_such", StringType())])
    rows = read_parquet(spark, f"{sf_small}/region.parquet", sch).collect()
    assert len(rows) == 5 and all(r.no_such is None for r in rows)


def test_sql_over_view(spark, sf_small):
    df = read_parquet(spark, f"{sf_small}/nation.parquet")
    assert sql_over_view(df, "n_view", "SELECT count(*) AS c FROM n_view WHERE n_regionkey = 0").first().c == 5


def test_json_landings_are_compressed_and_read_back_whole(spark):
    """SRC-1, SRC-9: a landing repeats its field names in every row."""
    from pyspark.sql import functions as F

    from tripstream.sinks.slices import land_in_slices
    from tripstream.sources.tables import read_json

    d = os.path.join(tempfile.mkdtemp(prefix="tripstream-json-"), "land")
    df = spark.range(3000).select(F.col("id"), F.expr("timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(0, 0, id, 0.000001)").alias("ts"), F.lit("a line").alias("note"))
    land_in_slices(df, "ts", d, lambda k: None, fmt="json")
    parts = [f for f in os.listdir(d) if f.startswith("part-")]
    assert parts and all(f.endswith(".json.gz") for f in parts)
    assert sum(os.path.getsize(os.path.join(d, f)) for f in parts) < 3000 * 25
    assert sorted(read_json(spark, d, df.schema).collect()) == sorted(df.collect())


def test_lineitem_moves_once_when_trips_are_joined(spark, sf_small):
    from tripstream.sources import bindings as B

    plan = B.raw_trips(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {t: min(len(x) - len(x.lstrip(" :+-")) for x in plan if "Relation" in x and t in x) for t in ("l_shipdate", "o_orderdate", "c_nationkey")}
    assert depth["l_shipdate"] < depth["o_orderdate"] and depth["l_shipdate"] < depth["c_nationkey"]
