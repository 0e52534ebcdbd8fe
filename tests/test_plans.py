"""Plan shape: the properties the design relies on at scale, checked on the physical plan."""

import os

import pytest

from snapmart.plans import queries, world

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _initial_plan(df) -> str:
    # AQE's initial plan: what Catalyst chose before any runtime statistics
    return df._jdf.queryExecution().sparkPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = _initial_plan(queries.REGISTRY["stg_games"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_latest_snapshot_filter_reaches_the_scan(spark):
    plan = _plan(queries.REGISTRY["stg_games"](spark, SF))
    assert "ScalarSubquery" in plan or "scalar-subquery" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scan and any("PushedFilters: [IsNotNull(extracted_at), EqualTo(extracted_at," in s for s in scan)


def test_raw_reads_prune_the_source_partition(spark):
    raw = world.raw_tables(spark, SF)["rawg"]
    plan = _plan(raw.select("extracted_at"))
    assert "PartitionFilters: [isnotnull(source" in plan and "(source" in plan


def test_no_expand_from_distinct_aggregates_in_the_mart(spark):
    plan = _initial_plan(queries.REGISTRY["mart_games"](spark, SF))
    assert "Expand" not in plan


def test_no_planned_broadcast_of_growing_rollups(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _initial_plan(queries.REGISTRY["mart_games"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # with size-based broadcasting off, no join may still broadcast: nothing is hinted
    assert "BroadcastHashJoin" not in plan


def test_top_n_is_a_partial_top_k(spark):
    plan = _initial_plan(queries.REGISTRY["mart_top_n"](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_flatten_is_a_generate_not_a_join(spark):
    plan = _initial_plan(queries.REGISTRY["flatten_one"](spark, SF))
    assert "Generate" in plan and "Join" not in plan


def test_backfill_range_reaches_the_scan(spark):
    plan = _plan(queries.REGISTRY["backfill_replay"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_envelopes_have_one_plan_shape_at_every_size(spark):
    import re
    big = "/root/testdata/sf0.1"
    if not os.path.isdir(big):
        pytest.skip("driver tables not present")
    shape = lambda sf: re.findall(r"[A-Z][A-Za-z]+(?=[ (])", re.sub(r"\[[^\]]*\]|\([^()]*\)", "", _logical(world.both_envelopes(spark, sf).bodies())))
    assert shape(SF) == shape(big)


def _logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_later_models_read_the_written_mart(spark):
    for name in ("mart_top_n", "kpi_release_trend"):
        plan = _initial_plan(queries.REGISTRY[name](spark, SF))
        assert "Generate" not in plan and "Window" not in plan and "Join" not in plan
