"""Driver contract: entry() runs; every query has an oracle or is rows-only; batch queries match DuckDB."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E

ROWS_ONLY: set[str] = set()
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "pickup_borough", "revenue_in_window", "trip_count", "avg_fare"]


def test_every_query_has_oracle():
    own = {n for n in E.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(__import__("tripstream.plans.catalog", fromlist=["x"]).BATCH_QUERIES))
def test_batch_query_matches_duckdb(spark, duck, sf_small, name):
    sdf = E.queries()[name](spark, sf_small)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    drows = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    assert srows == drows
