"""Single operators on small frames with known results."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from swelter.functions.expr import davies_jones, haversine_km, half_even_tenths, season, source_rank, wetbulb_stull
from swelter.operators import audit, backtest, catalog, daily, forecast, gaps, geo, merge, stations, stats
from swelter.sources import hourly, tables

D0 = dt.date(2020, 7, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_wetbulb_formulas(spark):
    t, td, p = np.array([20.0, 35.0, 10.0]), np.array([10.0, 30.0, 10.0]), 1000.0
    e = 6.112 * np.exp(17.67 * td / (td + 243.5))
    tw = davies_jones(t + 273.15, 0.622 * e / (p - 0.378 * e), np.full(3, p * 100))
    assert np.all(td - 1e-6 <= tw) and np.all(tw <= t + 1e-6) and abs(tw[2] - 10) < 1e-3
    assert np.isnan(davies_jones([300.0], [-0.1], [1e5])[0]) and np.isnan(davies_jones([np.nan], [0.01], [1e5])[0])
    one = spark.range(1).select(wetbulb_stull(F.lit(20.0), F.lit(50.0)).alias("w"), half_even_tenths(F.lit(0.25)).alias("r"), haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("k")).first()
    assert round(one.w, 2) == 13.70 and one.r == 0.2 and abs(one.k - np.pi * 6371) < 1e-6


def test_ranks_and_seasons(spark):
    got = spark.createDataFrame([("ECCC", dt.date(2020, 12, 1)), (None, dt.date(2020, 2, 1)), ("x", dt.date(2020, 9, 1))], "s string, d date").select(source_rank(F.col("s")), season(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(0, "Winter"), (2, "Winter"), (5, "Fall")]


def hours(spark, n, temp=300.0):
    return spark.createDataFrame([(1, dt.datetime(2020, 7, 1, h % 24, 30 * (h // 24)), temp, 0.015, 1e5) for h in range(n)], "location_id int, time timestamp_ntz, Tair double, Qair double, PSurf double")


def test_daily_needs_distinct_hours(spark):
    assert daily.daily_wetbulb(hours(spark, 20)).count() == 1
    assert daily.daily_wetbulb(hours(spark, 19)).count() == 0
    assert daily.daily_wetbulb(hours(spark, 30), with_hours=True).first().observed_hours == 24
    with pytest.raises(ValueError):
        daily.daily_wetbulb(hours(spark, 1), min_daily_hours=0)
    moved = hours(spark, 24).withColumn("utc_offset_hours", F.lit(-3.5))
    assert rows(daily.daily_wetbulb(moved, min_daily_hours=1, with_hours=True), "date", "observed_hours") == [(dt.date(2020, 6, 30), 4), (D0, 20)]


def spiky(spark, values):
    return spark.createDataFrame([(1, day(n), float(m), float(a)) for n, m, a in values], "location_id int, date date, wetbulb double, wetbulb_avg double")


def test_spikes(spark):
    base = [(n, 15, 12) for n in (0, 1, 3, 4)]
    assert daily.filter_daily_spikes(spiky(spark, [*base, (2, 30, 13)])).count() == 4
    assert daily.filter_daily_spikes(spiky(spark, [*base, (2, 30, 25)])).count() == 5  # its own mean supports it
    assert daily.filter_daily_spikes(spiky(spark, [(0, 15, 12), (1, 28, 12), (2, 30, 13), (3, 15, 12), (4, 15, 12)])).count() == 5  # the day before does
    assert daily.filter_daily_spikes(spiky(spark, [(0, 15, 12), (30, 40, 12), (60, 15, 12)])).count() == 3  # no neighbours
    assert daily.filter_daily_spikes(spiky(spark, [])).count() == 0


def pair(spark, offset, n=30):
    out = []
    for k in range(n):
        out += [(1, "a", "a", day(k), 20.0 + k % 3, 18.0, 24), (1, "b", "a", day(k), 20.0 + k % 3 + offset, 18.0 + offset, 20)]
    return spark.createDataFrame(out, "location_id int, station_id string, reference_station_id string, date date, wetbulb double, wetbulb_avg double, observed_hours int").withColumns({"variable_coverage": F.lit(0.9), "station_distance_km": F.lit(5.0)})


def test_homogenisation(spark):
    got = stations.homogenize_stations(pair(spark, 2.0)).where("station_id = 'b'").select("wetbulb_adjustment", "homogenization_overlap_days", "homogenization_method").distinct().collect()
    assert [tuple(r) for r in got] == [(-2.0, 30, "monthly_overlap")]
    assert stations.homogenize_stations(pair(spark, 16.4)).where("station_id = 'b'").count() == 0
    assert stations.homogenize_stations(pair(spark, 2.0, 19)).where("station_id = 'b'").count() == 0
    best = stations.select_best_station_days(stations.homogenize_stations(pair(spark, 2.0)))
    assert best.count() == 30 and {r.station_id for r in best.collect()} == {"a"}


def test_reference_prefers_first_ranks(spark):
    m = spark.createDataFrame([(1, "x", y, 1 if y < 2019 else 2, 0.5, 5.0, 1.0) for y in range(2000, 2021)] + [(1, "y", y, 2 if y < 2019 else 1, 0.9, 9.0, 2.0) for y in range(2000, 2021)], "location_id int, station_id string, year int, candidate_rank int, variable_coverage double, dist_km double, elevation_difference_m double")
    assert {r.reference_station_id for r in stations.assign_reference_stations(m).collect()} == {"x"}
    assert {r.reference_station_id for r in stations.assign_reference_stations(m, lookback_years=2).collect()} == {"y"}
    assert stations.station_map_for_years(m, [1999]).count() == 0


def test_gaps(spark):
    places = spark.createDataFrame([(1,), (2,)], "id int")
    have = spark.createDataFrame([(1, day(n), 1.0, 1.0, "isd") for n in range(5)] + [(2, day(0), None, 1.0, "isd"), (2, day(1), 1.0, 1.0, "nldas")], "location_id int, date date, wetbulb double, wetbulb_avg double, source string")
    window = {"start": D0, "end": day(30), "as_of": day(9)}
    assert rows(gaps.missing_cells(places, have, **window)) == sorted([(2, day(n)) for n in range(5)], key=str)
    assert gaps.missing_cells(places, have, **window, include_fill=True).count() == 4
    years = spark.createDataFrame([(1, dt.date(y, 1, 1)) for y in (1990, 1991, 1993, 1994, 1995)], "location_id int, date date")
    assert rows(gaps.gap_year_ranges(years)) == [(1, 1990, 1991), (1, 1993, 1995)]
    with pytest.raises(ValueError):
        gaps.fill_gaps(hours(spark, 24), years.select("location_id", "date"), source="nldas", incomplete=spark.createDataFrame([(1,)], "location_id int"))


def test_upsert_precedence(spark):
    shape = "location_id int, date date, wetbulb double, wetbulb_avg double, source string"
    old = spark.createDataFrame([(1, D0, 1.0, 1.0, "isd"), (2, D0, 1.0, 1.0, "eccc"), (3, D0, 1.0, 1.0, None)], shape)
    new = spark.createDataFrame([(1, D0, 2.0, 2.0, "ghcnh"), (1, D0, 3.0, 3.0, "nldas"), (2, D0, 2.0, 2.0, "ghcnh"), (3, D0, 2.0, 2.0, "lcd"), (4, D0, 9.0, 9.0, "era5land")], shape)
    got = {r.location_id: (r.wetbulb, r.source) for r in merge.upsert_by_precedence(old, new).collect()}
    assert got == {1: (2.0, "ghcnh"), 2: (1.0, "eccc"), 3: (2.0, "lcd"), 4: (9.0, "era5land")}
    assert {r.wetbulb for r in merge.merge_incremental(old, new.where("location_id = 2")).where("location_id = 2").collect()} == {2.0}


def test_daily_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for year, name, extra in ((2019, "wetbulb_batch_1", {}), (2020, "wetbulb_fill_batch_1", {}), (2020, "wetbulb_eccc_batch_1", {"source": ["eccc"], "observed_hours": [22]})):
        (tmp_path / f"year={year}").mkdir(exist_ok=True)
        pq.write_table(pa.table({"location_id": [1], "date": [D0], "wetbulb": [1.0], "wetbulb_avg": [1.0]} | extra), tmp_path / f"year={year}" / f"{name}.parquet")
    got = tables.read_daily(spark, str(tmp_path))
    assert sorted(r.source for r in got.collect()) == ["eccc", "isd", "nldas"]
    assert tables.read_daily(spark, str(tmp_path), start_year=2020).count() == 2
    assert [r.source for r in tables.read_daily(spark, str(tmp_path), kinds=("fill",)).collect()] == ["nldas"]


def test_written_years_replace_only_their_own(spark, tmp_path):
    shape = "location_id int, date date, wetbulb double, wetbulb_avg double"
    root = str(tmp_path / "daily")
    assert merge.pending_years(spark, root, [2019, 2020]).count() == 2
    merge.write_daily(spark.createDataFrame([(1, dt.date(2019, 1, 1), 1.0, 1.0), (1, dt.date(2020, 1, 1), 1.0, 1.0)], shape), root)
    merge.write_daily(spark.createDataFrame([(1, dt.date(2020, 1, 1), 2.0, 2.0)], shape), root)
    assert rows(spark.read.parquet(root), "year", "wetbulb") == [(2019, 1.0), (2020, 2.0)]
    assert rows(merge.pending_years(spark, root, [2019, 2021])) == [(2021,)]


def test_trend(spark):
    line = spark.createDataFrame([(1, y, 2.0 + 0.5 * (y - 2000)) for y in range(2000, 2020)], "k int, year int, value double")
    fit = forecast.trend_fit(line).first()
    assert abs(fit.coef1 - 0.5) < 1e-9 and fit.reference_year == 2009.5 and fit.rmse < 1e-9
    curve = line.withColumn("value", F.pow(F.col("year") - 2005, F.lit(2)))
    assert abs(forecast.trend_fit(curve, degree=2).first().coef2 - 1) < 1e-9
    assert forecast.trend_fit(line.where("year < 2001")).count() == 0
    assert forecast.rolling_origin_rmse(line.where("year < 2014")).first().cv_rmse == float("inf")
    assert forecast.trend_forecast(line).where("year = 2100").first().wetbulb == 52.0


def test_pooling(spark):
    reps = spark.createDataFrame([("a", 1.0, 0.1), ("a", 1.2, 0.2), ("b", 3.0, 0.5)], "metric string, slope double, slope_variance double")
    got = {r.metric: r for r in forecast.random_effects_pool(reps, keys=("metric",)).collect()}
    assert got["b"].fallback == "single_group" and got["b"].pooled_mean == 3.0 and got["a"].tau_squared == 0.0
    assert abs(got["a"].pooled_mean - (10 + 6) / 15) < 1e-9


def test_scenarios_extend_past_the_knots(spark):
    obs = spark.createDataFrame([(y, 1.0) for y in range(1990, 2026)], "year int, anomaly double")
    knots = spark.createDataFrame([("s", 2030, 1.0, 1.0, 1.0), ("s", 2050, 2.0, 2.0, 2.0)], "scenario string, year int, anomaly double, anomaly_lo double, anomaly_hi double")
    got = {r.year: r.anomaly for r in forecast.build_scenarios(obs, knots, end_year=2025).collect()}
    assert got[2026] == 1.0 and abs(got[2040] - 1.5) < 1e-9 and abs(got[2070] - 3.0) < 1e-9 and len(got) == 75


def test_calibration_takes_the_higher_quantile(spark):
    cases = spark.createDataFrame([(k, f"g{k}", 2010, 2011, 1, "avg_wetbulb", "Annual", float(k), 0.0, 0.0, -1.0, 1.0, False) for k in range(101)], "location_id int, station_group string, origin int, year int, horizon int, metric string, season string, actual double, gmst double, legacy double, lower double, upper double, oracle boolean")
    got = {r.metric: r.factor for r in backtest.calibration_factors(cases, 2012).collect()}
    assert got["avg_wetbulb"] == 70.0 and got["max_wetbulb"] == 1.0
    assert {r.factor for r in backtest.calibration_factors(cases.limit(99), 2012).collect()} == {1.0}


def test_near_pairs_miss_none(spark):
    rng = np.random.default_rng(0)
    left = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-85, 85, 200), rng.uniform(-180, 180, 200)))]
    right = [(i, a + rng.normal(0, 0.3), (b + rng.normal(0, 2) + 540) % 360 - 180) for i, a, b in left]
    got = geo.near_pairs(spark.createDataFrame(left, "i int, lat double, lng double"), spark.createDataFrame(right, "j int, r_lat double, r_lng double"), max_km=60)

    def km(a, b, c, d):
        h = np.sin(np.radians(c - a) / 2) ** 2 + np.cos(np.radians(a)) * np.cos(np.radians(c)) * np.sin(np.radians(d - b) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(min(h, 1)))

    want = [(i, j) for i, a, b in left for j, c, d in right if km(a, b, c, d) <= 60]
    assert rows(got, "i", "j") == sorted(want, key=str) and want


def test_unique_claims_follow_population(spark):
    rng = np.random.default_rng(1)
    cities = [(i, 40 + float(rng.integers(0, 6)) / 10, -100.0, int(rng.integers(0, 1000))) for i in range(40)]
    ranked = [(i, f"s{int(s)}", k + 1, float(k)) for i in range(40) for k, s in enumerate(rng.permutation(12)[:4])]
    avail = spark.createDataFrame([(f"s{s}", y) for s in range(12) for y in (1990, 2020) if (s + y) % 5], "station_id string, year int")
    kept, stations_ = catalog.claim_unique(spark.createDataFrame(cities, "location_id int, lat double, lng double, population long"), spark.createDataFrame(ranked, "location_id int, station_id string, station_rank int, dist_km double"), avail, start_year=1990, end_year=2020)
    cells, taken, want = set(), set(), []
    for i, lat, lng, p in sorted(cities, key=lambda c: (-c[3], c[0])):
        if round(lat / 0.1) in cells:
            continue
        for j, s, *_ in ranked:
            if j == i and s not in taken and (int(s[1:]) + 2020) % 5:
                cells.add(round(lat / 0.1))
                taken.add(s)
                want.append((i, s))
                break
    assert rows(stations_, "location_id", "station_id") == sorted(want, key=str) and kept.count() == len(want)


def test_claims_that_wait_for_each_other(spark):
    """Each city but the first wants its larger neighbour's station before its own, so one city is decided a round."""
    n = 7
    cities = spark.createDataFrame([(i, 40.0 + i, -100.0, 1000 - i) for i in range(n)], "location_id int, lat double, lng double, population long")
    ranked = spark.createDataFrame([(i, f"s{s}", k + 1, 1.0) for i in range(n) for k, s in enumerate([i - 1, i] if i else [0])], "location_id int, station_id string, station_rank int, dist_km double")
    avail = spark.createDataFrame([(f"s{s}", 2020) for s in range(n)], "station_id string, year int")
    _, stations_ = catalog.claim_unique(cities, ranked, avail, start_year=1990, end_year=2020)
    assert rows(stations_, "location_id", "station_id") == sorted([(i, f"s{i}") for i in range(n)], key=str)
    twice = cities.unionByName(cities.withColumn("population", F.col("population") + 1))
    with pytest.raises(ValueError, match="several rows"):
        catalog.claim_unique(twice, ranked, avail, start_year=1990, end_year=2020)


def test_points_without_a_cell_have_the_times_of_the_grid(spark):
    hours = [None, *(dt.datetime(2020, 1, d, h) for d, h in ((1, 0), (1, 23), (4, 5)))]  # two days without hours
    grid = spark.createDataFrame([(iy, 0, t, 280.0 + iy, 0.01, -9999.0) for iy in (0, 1) for t in hours], "iy int, ix int, time timestamp_ntz, Tair double, Qair double, PSurf double")
    points = spark.createDataFrame([(1, 1, 0), (2, -1, -1), (3, -1, 0)], "location_id int, iy int, ix int")
    got = hourly.hourly_grid_at_points(grid, points)
    assert rows(got) == sorted([(1, t, 281.0, 0.01, None) for t in hours[1:]] + [(i, t, None, None, None) for i in (2, 3) for t in hours[1:]], key=str)
    assert not any(w in got._jdf.queryExecution().optimizedPlan().toString() for w in ("Cross", "Cartesian"))
    assert rows(hourly.hourly_grid_at_points(grid.limit(0), points)) == []


def test_ranks_across_ranges(spark):
    places = [(f"p{i:03}", (i * 37 % 20) * 100 if i % 9 else None) for i in range(200)]
    got = catalog.by_population(spark.createDataFrame(places, "place_id string, population long").repartition(7)).collect()
    want = [p for p, _ in sorted(places, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))]
    assert [r.place_id for r in sorted(got, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in got) == list(range(1, 201))
    assert catalog.by_population(spark.createDataFrame([], "place_id string, population long")).count() == 0


def test_catalogue_guards(spark):
    c = spark.createDataFrame([(1, "a", "b", 1.0, 2.0)], "location_id int, city string, state string, lat double, lng double")
    assert catalog.locations_from_catalog([c]).columns == ["id", "city", "state", "lat", "lng"]
    with pytest.raises(ValueError):
        catalog.locations_from_catalog([c, c])


def test_folded_names(spark):
    got = spark.createDataFrame([("St. Jérôme",), ("SAINT-jerome",), ("Łódź",)], "n string").select(geo.folded_name(F.col("n"))).collect()
    assert [r[0] for r in got] == ["saint jerome", "saint jerome", "lodz"]


def test_folded_names_of_any_composition(spark):
    names = ["Đà Nẵng", "Da\u0300 Na\u0306\u0303ng", "Timi\u0219oara", "Timi\u015foara", "Ho\u0302i An", "Ǹgàtà"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(geo.folded_name(F.col("n"))).collect()
    assert [r[0] for r in got] == ["da nang", "da nang", "timisoara", "timisoara", "hoi an", "ngata"]


def test_bootstrap_ratios(spark):
    """Groups of equal errors give one ratio in every resample; otherwise the interval holds the ratio of all."""
    import random

    rng = random.Random(3)
    shape = "metric string, season string, station_group string, horizon int, actual double, gmst double, legacy double, lower double, upper double"
    case = lambda m, g, e: (m, "Annual", g, 6, 0.0, e, 2.0, -1.0, 1.0)
    rows = [case("even", f"g{k}", 1.0) for k in range(12)] + [case("mixed", f"g{k}", rng.uniform(0.2, 1.8)) for k in range(40)] + [case("mixed", "late", 9.0)[:3] + (11,) + case("mixed", "late", 9.0)[4:]]
    got = {r.metric: r for r in backtest.bootstrap_ratios(spark.createDataFrame(rows, shape), samples=300).collect()}
    assert set(got) == {"even", "mixed", None}
    assert got["even"].mae_ratio_low == got["even"].mae_ratio_high == got["even"].rmse_ratio_low == 0.5
    ratio = sum(abs(r[5]) for r in rows if r[0] == "mixed" and r[3] == 6) / 80
    assert got["mixed"].mae_ratio_low < ratio < got["mixed"].mae_ratio_high and got["mixed"].mae_ratio_high - got["mixed"].mae_ratio_low < 0.3


def test_offsets_of_time_zones(spark):
    got = spark.createDataFrame([("America/St_Johns",), ("Europe/Berlin",), ("America/Phoenix",)], "z string").select(geo.standard_offset_hours(F.col("z"))).collect()
    assert [r[0] for r in got] == [-3.5, 1.0, -7.0]


def test_isd_fields(spark):
    raw = spark.createDataFrame([("1", "2020-01-01T00:00:00", "10", "-90", "FM-15", "+0050,5", "-0010,5", "10175,5"), ("1", "2020-01-01T00:00:00", "10", "-90", "FM-12", "+0060,5", "+0010,5", "10175,5"), ("1", "2020-01-01T01:00:00", "10", "-90", "FM-15", "-9999,9", "+0010,5", "10175,5"), ("1", "2020-01-01T02:00:00", "10", "-90", "FM-15", "+0050,3", "+0010,5", "10175,5")], "STATION string, DATE string, ELEVATION string, LONGITUDE string, REPORT_TYPE string, TMP string, DEW string, SLP string")
    (row,) = hourly.hourly_isd(raw).collect()
    assert (row.time, row.tair_c, row.dewpoint_c) == (dt.datetime(2019, 12, 31, 18), 5.0, -1.0) and 1010 < row.pressure_hpa < 1017.5


def test_geojson_stations(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"features": [{"geometry": {"coordinates": [-75.0, 45.0]}, "properties": {"STN_ID": 7, "STATION_NAME": "A", "HAS_HOURLY_DATA": "Y", "ELEVATION": "80", "HLY_FIRST_DATE": "1990-02-01 00:00:00", "HLY_LAST_DATE": "2020-05-01 00:00:00"}}, {"geometry": {"coordinates": [-75.0, 45.0]}, "properties": {"STN_ID": 8, "HAS_HOURLY_DATA": "N"}}]}')
    assert rows(tables.read_station_inventory(spark, str(tmp_path / "p.json"), style="geojson")) == [("7", 45.0, -75.0, 80.0, 1990, 2020)]


def test_audits_on_small_frames(spark):
    obs = spark.createDataFrame([("d", 1, D0, "nldas", None), ("d", 1, D0, "ISD", 20), ("d", 1, day(1), None, 21), ("d", 2, D0, "era5land", None)], "dataset string, location_id int, date date, source string, observed_hours int")
    one = audit.deduplicate_by_source(obs)
    assert rows(one, "location_id", "date", "source") == sorted([(1, D0, "isd"), (1, day(1), "isd"), (2, D0, "era5land")], key=str)
    assert rows(audit.coverage_by_year(one), "total_days", "station_days", "station_pct") == [(3, 2, 66.67)]
    stats_ = stats.year_stats(spark.createDataFrame([(1, D0, 10.0, 9.0), (1, day(1), 20.0, 8.0)], "location_id int, date date, wetbulb double, wetbulb_avg double"))
    assert rows(stats_.where("season = 'Annual'"), "avg_wetbulb", "max_wetbulb", "p10") == [(15.0, 20.0, 11.0)]


SPAN = "location_id int, start_year int, end_year int"


def test_spans_are_recovered_whole_or_not_at_all(spark):
    """A range half covered, one covered by two spans side by side, one within a longer span, one from its first year, one of a city without any."""
    ranges = spark.createDataFrame([(1, 2000, 2003), (1, 2010, 2011), (2, 2000, 2003), (3, 1995, 1995), (4, 2000, 2001)], SPAN)
    fetched = spark.createDataFrame([(1, 2000, 2001), (1, 2008, 2015), (1, 2010, 2010), (2, 2000, 2001), (2, 2002, 2003), (3, 1995, 1999), (3, 1995, 1995)], SPAN)
    got = rows(gaps.span_recovery_report(ranges, fetched, allow_partial=True), "location_id", "expected", "recovered", "complete")
    assert got == [(1, 2, 1, False), (2, 1, 0, False), (3, 1, 1, True), (4, 1, 0, False)]
    with pytest.raises(ValueError, match=r"\[1, 2, 4\]"):
        gaps.span_recovery_report(ranges, fetched)
    assert gaps.span_recovery_report(ranges.where("location_id = 3"), fetched).count() == 1


def test_cells_of_recovered_spans(spark):
    missing = spark.createDataFrame([(1, dt.date(y, 1, 2)) for y in (2000, 2001, 2005)] + [(2, dt.date(2000, 1, 2))], "location_id int, date date")
    fetched = spark.createDataFrame([(1, 1999, 2001), (2, 2001, 2009)], SPAN)
    with pytest.raises(ValueError):
        gaps.recovered_cells(missing, fetched)
    assert rows(gaps.recovered_cells(missing, fetched, allow_partial=True)) == [(1, dt.date(2000, 1, 2)), (1, dt.date(2001, 1, 2))]


def test_day_sets_over_years(spark):
    """Leap years, the first and last days of years, rows outside the calendar, repeated rows, repeated and null locations."""
    there = {(1, D0 + dt.timedelta(n)) for n in range(0, 1200, 3)} | {(1, dt.date(y, m, d)) for y in (2020, 2021, 2022) for m, d in ((1, 1), (12, 31))} | {(1, dt.date(2020, 2, 29)), (1, dt.date(2031, 1, 1)), (1, dt.date(1970, 1, 1))}
    have = spark.createDataFrame([(i, d, 1.0, 1.0) for i, d in there] * 2, "location_id int, date date, wetbulb double, wetbulb_avg double")
    places = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    start, end = dt.date(2020, 1, 15), dt.date(2022, 12, 31)
    calendar = [start + dt.timedelta(n) for n in range((end - start).days + 1)]
    want = [(i, d) for i in (1, 1, 2, None) for d in calendar if (i, d) not in there]
    got = gaps.missing_cells(places, have, start=start, end=end, as_of=dt.date(2026, 1, 1))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert gaps.missing_cells(places, have, start=end, end=start, as_of=end).count() == 0
    plan = gaps.missing_cells(places, have, start=start, end=end, as_of=dt.date(2026, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4 and "LeftAnti" not in plan
    report = audit.validate_daily_coverage(places, have, start=start, end=end, as_of=dt.date(2026, 1, 1), sample=4).first()
    assert (report.missing, report.affected, len(report.sample)) == (len(want), 2, 4)


def test_years_with_broken_files_are_pending(spark, tmp_path):
    shape = "location_id int, date date, wetbulb double, wetbulb_avg double"
    root = tmp_path / "daily"
    days = spark.createDataFrame([(i, dt.date(y, 1, 1), 1.0, 1.0) for y in range(2015, 2021) for i in range(30)], shape)
    days.withColumn("year", F.year("date")).repartition(3, "location_id").write.partitionBy("year").parquet(str(root))
    parts = lambda y: sorted((root / f"year={y}").glob("*.parquet"))
    assert len(parts(2016)) > 1
    parts(2016)[0].write_bytes(parts(2016)[0].read_bytes()[:-20])  # one of several is cut short
    for p in parts(2017):
        p.write_bytes(b"")
    for p in parts(2018)[1:]:
        p.unlink()
    parts(2018)[0].write_bytes(b"PAR1 no footer PAR1")
    (root / "year=2022").mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"location_id": pa.array([], pa.int32())}), parts(2019)[0].parent / "part-none.parquet")  # whole, without rows
    assert rows(merge.pending_years(spark, str(root), range(2014, 2023))) == [(2014,), (2016,), (2017,), (2018,), (2021,), (2022,)]
    assert merge.pending_years(spark, str(root), range(2014, 2023), force=True).count() == 9


def test_a_merge_touches_only_its_years(spark, tmp_path):
    shape = "location_id int, date date, wetbulb double, wetbulb_avg double, source string"
    root = tmp_path / "daily"
    merge.merge_partitions(str(root), spark.createDataFrame([(1, dt.date(y, 1, 1), 1.0, 1.0, "isd") for y in range(2015, 2021)], shape))
    names = lambda: {p.parent.name: {x.name for x in p.parent.iterdir()} for p in root.glob("*/*.parquet")}
    before = names()
    batch = spark.createDataFrame([(1, dt.date(2016, 1, 1), 2.0, 2.0, "eccc"), (1, dt.date(2017, 1, 1), 2.0, 2.0, "era5land"), (1, dt.date(2021, 1, 1), 2.0, 2.0, None)], shape)
    merge.merge_partitions(str(root), batch)
    after = names()
    assert {y for y in after if after[y] != before.get(y)} == {"year=2016", "year=2017", "year=2021"}
    assert {r.year: r.wetbulb for r in spark.read.parquet(str(root)).collect()} == {2015: 1.0, 2016: 2.0, 2017: 1.0, 2018: 1.0, 2019: 1.0, 2020: 1.0, 2021: 2.0}
    plan = merge.touched_rows(spark.read.parquet(str(root)), batch)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_quantiles_with_an_outlier_and_ties(spark):
    """One score beyond all others must not gather them in one bin, nor equal scores in one task."""
    rng = np.random.default_rng(0)
    values = {"a": np.append(rng.random(20_000), 1e16), "b": np.repeat([1.0, 2.0, 3.0], 4000), "c": np.array([5.0]), "d": rng.random(7)}
    frame = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("e", None)], "k string, v double")
    for q in (0.0, 0.3, 0.7, 1.0):
        got = {r.k: (r.v, r.n) for r in backtest.exact_quantiles(frame, ["k"], "v", q).collect()}
        assert got == {k: (float(np.quantile(vs, q, method="higher")), len(vs)) for k, vs in values.items()}
    assert {r.k: r.v for r in backtest.exact_quantiles(frame, ["k"], "v", 0.7, accuracy=4).collect()} == {k: float(np.quantile(vs, 0.7, method="higher")) for k, vs in values.items()}
    lo, hi = backtest.brackets(frame, ["k"], "v", 0.7).where("k = 'a'").select("lo", "hi").first()
    assert 0 < ((values["a"] >= lo) & (values["a"] <= hi)).sum() <= 5 * 20_001 / backtest.ACCURACY + 2


def test_trends_of_two_metrics_in_one_pass(spark):
    """Against numpy, with years missing from one metric, a key with too few years, and one year only."""
    rng = np.random.default_rng(4)
    data = [(k, y, float(rng.normal(20 + 0.03 * (y - 1990) + 0.001 * (y - 2000) ** 2, 0.3)), None if (y * 7 + k) % 5 == 0 else float(rng.normal(15, 0.2))) for k, n in ((1, 36), (2, 13), (3, 1)) for y in range(1990, 1990 + n)]
    frame = spark.createDataFrame(data, "k int, year int, a double, b double")
    for degree in (1, 2):
        got = {r.k: r for r in forecast.trend_states(frame, ["k"], ["a", "b"], degree=degree).collect()}
        for k in (1, 2):
            for at, m in ((2, "a"), (3, "b")):
                pairs = [(r[1], r[at]) for r in data if r[0] == k and r[at] is not None]
                x, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
                c = np.polyfit(x - np.median(x), y, degree)[::-1]
                assert got[k][f"{m}_n"] == len(x) and got[k][f"{m}_last"] == x.max() and got[k][f"{m}_ref"] == np.median(x)
                assert np.allclose([got[k][f"{m}_c{i}"] for i in range(degree + 1)], c, atol=1e-8)
                assert abs(got[k][f"{m}_rmse"] - np.sqrt(np.mean((np.polyval(c[::-1], x - np.median(x)) - y) ** 2))) < 1e-6
                errors = [y[i] - np.polyval(np.polyfit(x[:i] - 2000, y[:i], degree), x[i] - 2000) for i in range(12, len(x))]
                assert got[k][f"{m}_late"] == len(errors) and (not errors or abs(got[k][f"{m}_late_sq"] - np.mean(np.square(errors))) < 1e-6)
        assert got[3].a_c1 is None
    daily = spark.createDataFrame([(1, D0, 1.0, 1.0)], "location_id int, date date, wetbulb double, wetbulb_avg double")
    assert forecast.trend_forecast_table(daily)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_dense_stations_are_many_keys(spark):
    """Nine tenths of the stations within one degree: the same pairs as without splitting, and no key has more than a few hundredths of them."""
    rng = np.random.default_rng(2)
    right = [(i, float(rng.uniform(45, 46)), float(rng.uniform(7, 8))) for i in range(1800)] + [(i, float(rng.uniform(-85, 85)), float(rng.uniform(-180, 180))) for i in range(1800, 2000)]
    left = [(i, float(rng.uniform(44.5, 46.5)), float(rng.uniform(6, 9))) for i in range(60)] + [(60, 45.0, 7.0), (61, 80.0, 7.5)]
    a, b = spark.createDataFrame(left, "i int, lat double, lng double"), spark.createDataFrame(right, "j int, r_lat double, r_lng double")
    split, whole = (geo.near_pairs(a, b, max_km=60, crowded=n).select("i", "j", F.round("km", 9).alias("km")) for n in (50, 10**9))
    assert rows(split) == rows(whole) and len(rows(whole)) > 1000
    _, keyed = geo._keyed(a, b, max_km=60, crowded=50)
    assert keyed.groupBy("_y", "_x", "_fy", "_fx").count().agg(F.max("count")).first()[0] < 2000 * 0.03


def test_pairs_across_the_antimeridian_and_at_the_poles(spark):
    left = [(0, 10.0, 179.9), (1, -10.0, -179.95), (2, 89.9, 10.0), (3, -89.95, -170.0), (4, 87.6, 179.0)]
    right = [(0, 10.1, -179.9), (1, -10.0, 179.9), (2, 89.95, -170.0), (3, -89.9, 20.0), (4, 87.6, -179.0), (5, 0.0, 0.0)] * 30
    a, b = spark.createDataFrame(left, "i int, lat double, lng double"), spark.createDataFrame(right, "j int, r_lat double, r_lng double")
    for crowded in (10, 10**9):
        got = geo.near_pairs(a, b, max_km=60, crowded=crowded).groupBy("i", "j").count().collect()
        assert sorted(tuple(r) for r in got) == [(k, k, 30) for k in range(5)]


def test_names_that_no_source_has_are_errors(spark):
    place = "place_id string, city string, state string, country string, population long, lat double, lng double"
    us, ca = spark.createDataFrame([("US1", "a", "S", "US", 5, 1.0, 1.0)], place), spark.createDataFrame([("CA1", "x", "P", "CA", 9, 1.0, 1.0)], place)
    roster = lambda *names: spark.createDataFrame([(None, n, "S") for n in names], "place_id string, city string, state string")
    metros = lambda *names: spark.createDataFrame([(n, n, "P", 7) for n in names], "metro_id string, city string, state string, metro_population long")
    assert catalog.metro_candidates(us, us.limit(0), roster("a"), ca, metros("x")).count() == 2
    with pytest.raises(ValueError, match="roster"):
        catalog.metro_candidates(us, us.limit(0), roster("a", "gone"), ca, metros("x"))
    with pytest.raises(ValueError, match="metropolitan"):
        catalog.metro_candidates(us, us.limit(0), roster("a"), ca, metros("x", "gone"))
    assert catalog.metro_candidates(us, us.limit(0), roster("gone"), ca, metros("gone"), allow_missing=True).count() == 0


def test_kinds_of_daily_files_are_scanned_apart(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for year, name, extra in ((2019, "wetbulb_batch_1", {"station_id": ["s"]}), (2020, "wetbulb_fill_batch_1", {"unknown": [1]}), (2020, "wetbulb_eccc_batch_1", {"source": ["eccc"], "observed_hours": pa.array([22], pa.int32())})):
        (tmp_path / f"year={year}").mkdir(exist_ok=True)
        pq.write_table(pa.table({"location_id": pa.array([1], pa.int32()), "date": [D0], "wetbulb": pa.array([1.5], pa.float32()), "wetbulb_avg": [1.0]} | extra), tmp_path / f"year={year}" / f"{name}.parquet")
    fill = tables.read_daily(spark, str(tmp_path), kinds=("fill",))
    assert [f.rsplit("/", 1)[1] for f in fill.inputFiles()] == ["wetbulb_fill_batch_1.parquet"]
    got = {r.source: r for r in tables.read_daily(spark, str(tmp_path)).collect()}
    assert {k: (r.location_id, r.wetbulb, r.observed_hours, r.station_id, r.year) for k, r in got.items()} == {"isd": (1, 1.5, None, "s", 2019), "nldas": (1, 1.5, None, None, 2020), "eccc": (1, 1.5, 22, None, 2020)}
    assert tables.read_daily(spark, str(tmp_path), start_year=2021).count() == 0


def test_reports_that_tie_are_kept_the_same_however_rows_are_dealt(spark):
    raw = [("s", "2020-01-01 00:00:00", "FM-15", "10", "20.0", "10.0", str(1000 + k), None, None) for k in range(40)]
    columns = "station_id string, DATE string, REPORT_TYPE string, ELEVATION string, HourlyDryBulbTemperature string, HourlyDewPointTemperature string, HourlyStationPressure string, HourlySeaLevelPressure string, HourlyAltimeterSetting string"
    for order in (raw, raw[::-1], raw[20:] + raw[:20]):
        assert hourly.hourly_lcd(spark.createDataFrame(order, columns).coalesce(1)).first().pressure_hpa == 1039.0


def test_representative_does_not_hang_on_the_last_bits_of_a_variance(spark):
    shape = "location_id int, season string, metric string, n int, slope double, slope_variance double"
    fits = [(1, "Annual", "m", 30, 1.0, 0.1 + 0.2), (2, "Annual", "m", 30, 2.0, 0.3), (3, "Annual", "m", 30, 3.0, 0.3001), (4, "Annual", "m", 29, 4.0, 1e-8)]
    groups = spark.createDataFrame([(k, "g") for k in range(1, 5)], "location_id int, station_group string")
    assert [r.location_id for r in forecast.group_representatives(spark.createDataFrame(fits, shape), groups).collect()] == [1]


def test_series_are_equal_with_all_rows_of_a_day_or_with_the_best(spark):
    shape = "location_id int, date date, wetbulb double, wetbulb_avg double, source string"
    rows_ = [(k, day(n), 1.0 * n, 0.5, "isd") for k in (1, 2) for n in range(3)] + [(2, day(1), 0.0, 0.5, "nldas")]
    found = lambda **o: [r.location_ids for r in audit.duplicate_series(spark.createDataFrame(rows_, shape), **o).collect()]
    assert found() == [[1, 2]] and found(best_source=False) == []


def test_place_numbers_may_begin_anew_in_each_file(spark):
    est = spark.createDataFrame([(f, "162", "1", "7", f"Place{f} city", str(100 + f)) for f in (0, 1)], "file int, SUMLEV string, STATE string, PLACE string, NAME string, POPESTIMATE2023 string")
    gaz = spark.createDataFrame([(f, "0100007", str(30.0 + f), "-90.0") for f in (0, 1)], "file int, GEOID string, INTPTLAT string, INTPTLONG string")
    assert rows(tables.read_places_us(est, gaz, by=["file"]), "place_id", "city", "population", "lat") == [("US0100007", "Place0", 100, 30.0), ("US0100007", "Place1", 101, 31.0)]
    assert rows(tables.read_places_us(est, gaz), "city") == [("Place1",)]


def test_places_at_one_point_are_matched_once(spark):
    """Cities and stations at few points: what is ranked is the same as by all pairs, and pairs are made for sites and not for cities."""
    made = []
    near, geo.near_pairs = geo.near_pairs, lambda *a, **o: made.append(near(*a, **o)) or made[-1]
    try:
        cities = spark.range(300).selectExpr("cast(id as int) location_id", "40 + id % 3 * 0.1 lat", "-100.0D lng", "cast(id % 2 * 100 as double) dem_m")
        cities = cities.withColumn("lat", F.col("lat").cast("double"))
        at = spark.range(400).selectExpr("concat('s', lpad(id, 4, '0')) station_id", "cast(40 + id % 4 * 0.1 as double) lat", "-100.0D lon", "cast(id % 2 * 50 as double) elev_m", "cast(1985 + id % 3 * 10 as int) begin_year", "cast(2015 + id % 5 as int) end_year")
        scores = at.selectExpr("station_id", "cast(substr(station_id, 4, 2) as int) % 3 / 3.0D score")
        seen = at.selectExpr("station_id", "explode(array(1990, 2020)) year").where("(cast(substr(station_id, 2) as int) + year) % 7 <> 0")
        got = [geo.rank_station_candidates(cities, at, scores).where("candidate_rank <= 5"), geo.rank_station_candidates_recent_history(cities, at), geo.first_verified_station(cities, at, seen, start_year=1990, end_year=2020), geo.nearest_place_attributes(cities.selectExpr("location_id place_id", "lat", "lng"), at.selectExpr("station_id name", "lat", "lon lng", "elev_m dem_m", "'Europe/Berlin' timezone"))]
        assert [g.count() for g in got] == [1500, 1500, 300, 300]
        # sites times the stations that names alone do not tell apart: 6 x at most 5 of each kind, far below 300 x 400
        assert [m.count() < n for m, n in zip(made, (1000, 3000, 1000, 20), strict=True)] == [True] * 4
        ranked = geo.rank_station_rows(cities, at, start_year=1990, end_year=2020)
        assert ranked.count() == 300 * 400
        assert rows(got[2]) == rows(geo.pick_verified_station(ranked, seen, start_year=1990, end_year=2020))
    finally:
        geo.near_pairs = near


def test_claims_look_at_the_largest_cities_only(spark):
    cities = spark.range(9000).selectExpr("cast(id as int) location_id", "cast(id as double) lat", "0.0D lng", "id div 2 population")
    avail = spark.createDataFrame([("s", 2020), ("t", 2020)], "station_id string, year int")
    asked = []

    def ranked(some):
        asked.append(some.count())
        return some.where("location_id < 8900").selectExpr("location_id", "if(location_id % 5 = 0, 's', 't') station_id", "1 station_rank", "1.0D dist_km")

    _, stations_ = catalog.claim_unique(cities, ranked, avail, start_year=1990, end_year=2020, limit=2)
    assert sorted((r.location_id, r.station_id) for r in stations_.collect()) == [(8895, "s"), (8898, "t")]
    assert asked[0] < 100 and asked == sorted(asked) and asked[-1] < 9000
