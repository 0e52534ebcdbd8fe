"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.compare import TABLES, rows_of
from snapmart.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries.REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = con.sql(entry.oracle_sql()[name]).arrow().read_all()
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "rawg_game_id" and df.count() <= 25


def test_fused_and_model_plans_agree_on_driver_tables(spark):
    a = queries.accumulated_mart(spark, SF)
    b = queries.accumulated_mart_by_models(spark, SF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", ["epoch_to_ts", "stg_offers", "dq_freshness", "mart_load_summary", "raw_copy"])
def test_time_queries_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = entry.queries()[name](spark, SF).toArrow()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert rows_of(got) == rows_of(con.sql(entry.oracle_sql()[name]).arrow().read_all())
