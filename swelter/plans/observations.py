"""Queries from hourly observations to homogenised daily rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from swelter.functions.expr import KELVIN, rounded, specific_humidity
from swelter.operators import daily, stations
from swelter.plans.registry import query
from swelter.plans.statistics import r

KEYS = ("location_id", "station_id")

#: Davies-Jones by thirty bisections in a recursive CTE over rows (id, t, q, p).
WET = """es(id, t, p, e) AS (SELECT id, t, p, q * p / (0.622 + (1 - 0.622) * q) FROM (SELECT id, t, q, p / 100.0 AS p FROM hi)),
    dw AS (SELECT id, t, p, e, 243.5 * ln(e / 6.112) / (17.67 - ln(e / 6.112)) + 273.15 AS dew, 0.622 * e / (p - e) AS w FROM es WHERE e > 0 AND e < p),
    lc AS (SELECT *, 1.0 / (1.0 / (dew - 56.0) + ln(t / dew) / 800.0) + 56.0 AS tl FROM dw),
    th AS (SELECT id, p, dew, t, t * power(1000.0 / p, 0.2854 * (1 - 0.28 * w)) * exp((3.376 / tl - 0.00254) * w * 1000.0 * (1 + 0.81 * w)) AS goal FROM lc),
    bi(id, p, goal, lo, hi, k) AS (SELECT id, p, goal, dew, t, 0 FROM th UNION ALL
        SELECT id, p, goal, CASE WHEN cur < goal THEN mid ELSE lo END, CASE WHEN cur < goal THEN hi ELSE mid END, k + 1
        FROM (SELECT *, mid * power(1000.0 / p, 0.2854 * (1 - 0.28 * w)) * exp((3.376 / mid - 0.00254) * w * 1000.0 * (1 + 0.81 * w)) AS cur
            FROM (SELECT *, 0.622 * s / (p - s) AS w FROM (SELECT *, 6.112 * exp(17.67 * (mid - 273.15) / (mid - 273.15 + 243.5)) AS s FROM (SELECT *, 0.5 * (lo + hi) AS mid FROM bi WHERE k < 30)))))"""


def daily_sql(hourly: str, keys: str, hours: int, place: str = "") -> str:
    """CTEs that end in dy: keys, date, wetbulb, wetbulb_avg, observed_hours."""
    return f"""WITH RECURSIVE hr AS (SELECT *, row_number() OVER (ORDER BY event_id, {keys}) AS id FROM ({hourly})), hi AS (SELECT id, tair AS t, qair AS q, psurf AS p FROM hr), {WET},
    tw AS (SELECT hr.*, 0.5 * (lo + hi) - 273.15 AS tw FROM bi JOIN hr USING (id) WHERE k = 30),
    dy AS (SELECT {keys}, CAST(time AS DATE) AS date, round_even(max(tw) * 10, 0) / 10 AS wetbulb, round_even(avg(tw) * 10, 0) / 10 AS wetbulb_avg, CAST(count(DISTINCT hour(time)) AS INT) AS observed_hours
        FROM tw WHERE tw BETWEEN -50 AND 35 GROUP BY {keys}, CAST(time AS DATE) HAVING count(DISTINCT hour(time)) >= {hours})"""


_ES = "6.112 * exp(17.67 * dewpoint_c / (dewpoint_c + 243.5))"
HOURLY = f"SELECT event_id, location_id, station_id, time, tair_c + 273.15 AS tair, 0.622 * {_ES} / (pressure_hpa - (1 - 0.622) * {_ES}) AS qair, pressure_hpa * 100 AS psurf FROM {{hourly_obs}}"
MAP = "SELECT DISTINCT location_id, station_id FROM {hourly_obs}"
#: Each station row goes to every city that uses the station.
FANNED = f"SELECT h.event_id, m.location_id, h.station_id, h.time, tair, qair, psurf FROM ({HOURLY}) h JOIN ({MAP}) m ON h.station_id = m.station_id"


def _hourly(t):
    """Hours with the location they were taken at, in model units."""
    h = t.hourly_obs
    return h.select("location_id", "station_id", "time", (F.col("tair_c") + KELVIN).alias("Tair"), specific_humidity(F.col("dewpoint_c"), F.col("pressure_hpa")).alias("Qair"), (F.col("pressure_hpa") * 100).alias("PSurf"))


def _map(t):
    return t.hourly_obs.select(*KEYS).distinct()


@query("d1_daily_wetbulb", f"{daily_sql(HOURLY, 'location_id', 12)} SELECT location_id, date, wetbulb, wetbulb_avg, observed_hours FROM dy")
def _(t):
    return daily.daily_wetbulb(_hourly(t), min_daily_hours=12, with_hours=True)


@query("d1_daily_wetbulb_default", f"{daily_sql(HOURLY, 'location_id', 20)} SELECT location_id, date, wetbulb, wetbulb_avg FROM dy")
def _(t):
    return daily.daily_wetbulb(_hourly(t))


_C, _RH = "(tair - 273.15)", "(100 * (qair * psurf / 100 / (0.622 + 0.378 * qair)) / (6.112 * exp(17.67 * (tair - 273.15) / (tair - 273.15 + 243.5))))"
STULL = f"{_C} * atan(0.151977 * sqrt({_RH} + 8.313659)) + atan({_C} + {_RH}) - atan({_RH} - 1.676331) + 0.00391838 * power({_RH}, 1.5) * atan(0.023101 * {_RH}) - 4.686035"


@query(
    "d1_daily_wetbulb_stull",
    f"""SELECT location_id, CAST(time AS DATE) AS date, round_even(max(tw) * 10, 0) / 10 AS wetbulb, round_even(avg(tw) * 10, 0) / 10 AS wetbulb_avg, CAST(count(DISTINCT hour(time)) AS INT) AS observed_hours
    FROM (SELECT *, {STULL} AS tw FROM ({HOURLY})) WHERE tw BETWEEN -50 AND 35 GROUP BY 1, 2 HAVING count(DISTINCT hour(time)) >= 12""",
)
def _(t):
    return daily.daily_wetbulb(_hourly(t), min_daily_hours=12, with_hours=True, method="stull")


@query("d2_location_hourly_from_station", f"SELECT location_id, station_id, CAST(time AS DATE) AS date, count(*) AS n, {r('sum(tair)', 3)} AS tair, {r('sum(qair)', 6)} AS qair, {r('sum(psurf)', 3)} AS psurf FROM ({FANNED}) GROUP BY 1, 2, 3")
def _(t):
    rows = daily.location_hourly_from_station(t.hourly_obs.drop("location_id"), _map(t))
    return rows.groupBy(*KEYS, F.col("time").cast("date").alias("date")).agg(F.count("*").alias("n"), rounded(F.sum("Tair"), 3).alias("tair"), rounded(F.sum("Qair"), 6).alias("qair"), rounded(F.sum("PSurf"), 3).alias("psurf"))


def _neighbour(f: str, sign: str, k: int, gap: str) -> str:
    days = f"date - {f}(date, {k}) OVER w" if sign == "+" else f"{f}(date, {k}) OVER w - date"
    return f"CASE WHEN {days} {gap} THEN {f}(wetbulb, {k}) OVER w END"


def spikes_sql(source: str, keys: str) -> str:
    near = ", ".join(_neighbour(f, s, k, "<= 3") for k in (1, 2, 3) for f, s in (("lag", "+"), ("lead", "-")))
    beside = ", ".join(_neighbour(f, s, 1, "= 1") for f, s in (("lag", "+"), ("lead", "-")))
    return f"""(SELECT * EXCLUDE (near, beside) FROM (SELECT *, list_filter([{near}], lambda x: x IS NOT NULL) AS near, greatest({beside}) AS beside FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY date))
        WHERE NOT coalesce(len(near) >= 2 AND wetbulb - list_median(near) >= 8 AND wetbulb - wetbulb_avg >= 10 AND NOT coalesce(beside >= wetbulb - 3, false), false))"""


#: Every 17th candidate day of a station stands out.
SPIKED = "(SELECT location_id, station_id, date, CASE WHEN [[dayno date]] % 17 = 0 THEN wetbulb + 40 ELSE wetbulb END AS wetbulb, CASE WHEN [[dayno date]] % 34 = 0 THEN wetbulb_avg + 38 ELSE wetbulb_avg END AS wetbulb_avg FROM {candidates_daily})"


@query("d3_filter_daily_spikes", f"SELECT location_id, station_id, date, {r('wetbulb', 1)} AS wetbulb, {r('wetbulb_avg', 1)} AS wetbulb_avg FROM {spikes_sql(SPIKED, 'location_id, station_id')}")
def _(t):
    n = F.datediff("date", F.lit("1990-01-01"))
    rows = t.candidates_daily.select(*KEYS, "date", F.when(n % 17 == 0, F.col("wetbulb") + 40).otherwise(F.col("wetbulb")).alias("wetbulb"), F.when(n % 34 == 0, F.col("wetbulb_avg") + 38).otherwise(F.col("wetbulb_avg")).alias("wetbulb_avg"))
    return daily.filter_daily_spikes(rows, keys=KEYS).withColumns({c: rounded(c, 1) for c in ("wetbulb", "wetbulb_avg")})


@query(
    "d4_candidate_daily",
    f"""{daily_sql(FANNED, 'location_id, station_id', 8)} SELECT location_id, station_id, date, wetbulb, wetbulb_avg, observed_hours, 'ghcnh' AS source, CASE WHEN observed_hours >= 20 THEN 'complete' ELSE 'sparse' END AS station_quality,
    CAST(location_id + CAST(station_id AS INT) + 1 AS INT) AS candidate_rank, CAST(5 + CAST(station_id AS INT) * 7 AS DOUBLE) AS station_distance_km
    FROM {spikes_sql('dy', 'location_id, station_id')} WHERE year(date) >= 2000 + CAST(station_id AS INT) AND (station_id <> '2' OR year(date) <= 2100)""",
)
def _(t):
    s = F.col("station_id").cast("int")
    m = _map(t).withColumns({"candidate_rank": F.col("location_id") + s + 1, "dist_km": (5 + s * 7).cast("double"), "start_year": 2000 + s, "end_year": F.when(s == 2, 2100)})
    out = daily.candidate_daily(t.hourly_obs.drop("location_id"), m, source="ghcnh", min_daily_hours=8)
    return out.select(*KEYS, "date", "wetbulb", "wetbulb_avg", "observed_hours", "source", "station_quality", "candidate_rank", "station_distance_km")


#: A year-specific station map from the candidate rows.
YEAR_MAP = """SELECT location_id, station_id, CAST(year(date) AS INT) AS year, CAST(1 + (year(date) + location_id + count(*) % 3) % 3 AS INT) AS candidate_rank, avg(variable_coverage) AS variable_coverage,
    CAST(5 + count(*) % 7 AS DOUBLE) AS dist_km, CAST(count(*) % 11 AS DOUBLE) AS elevation_difference_m FROM {candidates_daily} GROUP BY location_id, station_id, year(date)"""


def _year_map(t):
    return t.spark.sql(YEAR_MAP, candidates_daily=t.candidates_daily)


@query("c1_station_map_for_years", f"SELECT * FROM ({YEAR_MAP}) WHERE year IN (1996, 1998) AND station_id <> 's2'")
def _(t):
    return stations.station_map_for_years(_year_map(t), [1998, 1996], excluded=["s2"])


@query(
    "c2_assign_reference_stations",
    f"""WITH m AS ({YEAR_MAP}), s AS (SELECT location_id, station_id, sum(CASE WHEN candidate_rank = 1 THEN 1 ELSE 0 END) AS f, count(*) AS n, avg(variable_coverage) AS c, median(dist_km) AS k, median(elevation_difference_m) AS e
        FROM m WHERE year >= (SELECT max(year) FROM m) - 3 GROUP BY ALL), b AS (SELECT location_id, station_id AS reference_station_id FROM s QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY f DESC, n DESC, round(c, 9) DESC, k, e, station_id) = 1)
    SELECT m.location_id, station_id, year, candidate_rank, reference_station_id FROM m LEFT JOIN b USING (location_id)""",
)
def _(t):
    return stations.assign_reference_stations(_year_map(t), lookback_years=4).select("location_id", "station_id", "year", "candidate_rank", "reference_station_id")


HOMOGENISED = """cd AS (SELECT * FROM {candidates_daily}), rf AS (SELECT location_id, date, wetbulb AS rw, wetbulb_avg AS ra FROM cd WHERE station_id = 's0'),
    sc AS (SELECT * FROM cd WHERE station_id <> 's0'), pr AS (SELECT sc.*, rw - wetbulb AS dw, ra - wetbulb_avg AS da FROM sc JOIN rf USING (location_id, date)),
    mo AS (SELECT location_id, station_id, month(date) AS mm, count(*) AS mn, median(dw) AS mw, median(da) AS ma FROM pr GROUP BY ALL), ov AS (SELECT location_id, station_id, count(*) AS gn, median(dw) AS gw, median(da) AS ga FROM pr GROUP BY ALL),
    jn AS (SELECT sc.*, CASE WHEN mn >= LO THEN mn ELSE gn END AS n, CASE WHEN mn >= LO THEN mw ELSE gw END AS aw, CASE WHEN mn >= LO THEN ma ELSE ga END AS aa, CASE WHEN mn >= LO THEN 'monthly_overlap' ELSE 'global_overlap' END AS method
        FROM sc JOIN ov USING (location_id, station_id) LEFT JOIN mo ON mo.location_id = sc.location_id AND mo.station_id = sc.station_id AND mm = month(date) WHERE coalesce(mn >= LO, false) OR gn >= HI),
    ok AS (SELECT * FROM jn QUALIFY max(greatest(abs(aw), abs(aa))) OVER (PARTITION BY location_id, station_id) <= 5),
    hs AS (SELECT * REPLACE (wetbulb + aw AS wetbulb, wetbulb_avg + aa AS wetbulb_avg) FROM ok WHERE wetbulb + aw BETWEEN -50 AND 35 AND wetbulb_avg + aa BETWEEN -50 AND 35
        UNION ALL SELECT *, 0, 0.0, 0.0, 'reference' FROM cd WHERE station_id = 's0')""".replace("LO", "5").replace("HI", "20")


def _homogenised(t):
    return stations.homogenize_stations(t.candidates_daily, min_month_days=5, min_global_days=20)


@query("c3_homogenize_stations", f"WITH {HOMOGENISED} SELECT location_id, station_id, date, {r('wetbulb', 2)} AS wetbulb, {r('wetbulb_avg', 2)} AS wetbulb_avg, method AS homogenization_method, CAST(n AS INT) AS homogenization_overlap_days, {r('aw', 2)} AS wetbulb_adjustment, {r('aa', 2)} AS wetbulb_avg_adjustment FROM hs")
def _(t):
    cols = ("wetbulb", "wetbulb_avg", "wetbulb_adjustment", "wetbulb_avg_adjustment")
    return _homogenised(t).withColumns({c: rounded(c, 2) for c in cols}).select(*KEYS, "date", "wetbulb", "wetbulb_avg", "homogenization_method", "homogenization_overlap_days", *cols[2:])


@query(
    "c4_select_best_station_days",
    f"""WITH {HOMOGENISED} SELECT location_id, station_id, date, {r('wetbulb', 2)} AS wetbulb, observed_hours FROM hs
    QUALIFY row_number() OVER (PARTITION BY location_id, date ORDER BY station_id = reference_station_id DESC, observed_hours DESC, variable_coverage DESC, station_distance_km, station_id) = 1""",
)
def _(t):
    return stations.select_best_station_days(_homogenised(t)).select(*KEYS, "date", rounded("wetbulb", 2).alias("wetbulb"), "observed_hours")
