"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from swelter.plans import registry

DIR = "/root/testdata/sf0.001"
#: One or two of each area; the driver runs them all at a larger scale.
NAMES = ("v2_year_stats", "v5_city_rankings", "p2_rolling_origin_rmse", "p9_gmst_forecast", "d4_candidate_daily", "c3_homogenize_stations", "f3_gap_year_ranges", "l4_upsert_by_precedence", "g1_rank_station_candidates", "g5_snap_to_land", "k1_metro_candidates", "q4_duplicate_series", "s3_hourly_isd", "v3_yearly_qualified", "v3_yearly_qualified_max", "v4_unpivot_metrics", "q8_check_rules", "q8_check_rules_values", "l1_write_daily", "g7_match_city_centers", "g7_match_city_centers_overrides", "k3_claim_unique", "b7_bootstrap_ratios", "s1_read_daily_inferred", "s12_read_station_inventory_geojson", "s13_read_dimensions_all", "f1_missing_cells", "f5_span_recovery_report", "f5_recovered_cells", "q7_validate_daily_coverage", "l2_pending_years", "l4_merge_partitions", "b3_calibration_factors", "p3_trend_forecast_quadratic", "p4_trend_forecast_table", "q8_check_rules_faults", "g5_snap_to_land_outward", "s2_hourly_ghcnh_before_today", "s5_hourly_eccc_before_today", "s6_missing_share", "d1_daily_wetbulb_stull", "k5_station_groups", "s8_hourly_grid_at_points")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DIR}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, DIR)
    want = duck.sql(registry.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    mine = sorted(str([plain(r[c]) for c in columns]) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert mine == sorted(str([plain(r[k]) for k in at]) for r in want.fetchall())


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES) and len(registry.QUERIES) > 80


def test_backtest_queries_take_the_whole_range(spark):
    from swelter.plans import backtests

    assert (list(backtests.ORIGINS), list(backtests.GATES)) == (list(range(2009, 2025)), list(range(2012, 2025)))
    if os.path.isdir(DIR):
        origins = {r.origin for r in registry.QUERIES["b2_backtest_cases"](spark, DIR).select("origin").distinct().collect()}
        assert origins == set(range(2009, 2025))


@pytest.fixture(scope="module")
def far_keys(tmp_path_factory):
    """Tables of few suppliers, whose keys are those of a table hundreds of times larger."""
    if not os.path.isdir(DIR):
        pytest.skip("the driver's tables are not here")
    folder = tmp_path_factory.mktemp("far")
    con = duckdb.connect()
    con.sql(f"copy (select * from '{DIR}/nation.parquet') to '{folder}/nation.parquet' (format parquet)")
    con.sql(f"copy (select s_suppkey + x as s_suppkey, s_name || x as s_name, s_nationkey, s_acctbal from '{DIR}/supplier.parquet' cross join (values (0), (97300), (271000)) v(x)) to '{folder}/supplier.parquet' (format parquet)")
    for name in ("nation", "supplier"):
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ("v5_city_rankings_eu", "l3_merge_incremental", "l4_upsert_by_precedence", "l4_merge_partitions", "p9_gmst_forecast", "q1_deduplicate_by_source"))
def test_supplier_keys_beyond_32_bit_products(spark, far_keys, name):
    folder, con = far_keys
    got, want = registry.QUERIES[name](spark, folder), con.sql(registry.ORACLES[name])
    columns = sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([plain(r[c]) for c in columns]) for r in got.collect()) == sorted(str([plain(r[k]) for k in at]) for r in want.fetchall())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
def test_days_are_dealt_by_location_before_they_are_made(spark):
    def plan(name):
        return registry.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("b1_annual_metrics", "q1_deduplicate_by_source", "v2_year_stats"):
        dealt = [x for x in plan(name).splitlines() if "Exchange hashpartitioning" in x]
        assert dealt and all("REPARTITION_BY_NUM" in x and f", {tasks})" in x for x in dealt), name


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
def test_cases_go_through_the_days_once(spark):
    for name in ("b2_backtest_cases", "b2_backtest_cases_oracle", "b5_evaluate_gate"):
        assert "s_suppkey" not in registry.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
def test_no_year_of_the_landed_days_passes_through_one_task(spark):
    got = registry.QUERIES["s1_read_daily"](spark, DIR)
    files = got.inputFiles()
    assert len([f for f in files if "year=2000" in f]) > 1
