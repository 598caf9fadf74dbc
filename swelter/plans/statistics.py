"""Queries of the seasonal statistics and rankings."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from swelter.functions.expr import rounded
from swelter.operators import forecast, stats
from swelter.plans.registry import query

AS_OF = datetime.date(2026, 1, 1)

SEASON = "CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
SEASONS_SQL = f"(SELECT *, 'Annual' AS season FROM {{dense_daily}} UNION ALL SELECT *, {SEASON} FROM {{dense_daily}})"
NEED = "CASE WHEN season = 'Annual' THEN CASE WHEN year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0) THEN 366 ELSE 365 END WHEN season = 'Winter' THEN CASE WHEN year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0) THEN 91 ELSE 90 END WHEN season IN ('Spring', 'Summer') THEN 92 ELSE 91 END"


def r(x: str, n: int) -> str:
    """Decimal rounding to a double, as the jobs round."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def _stat(c: str, tail: str) -> str:
    q = ", ".join(f"{r(f'quantile_cont({c}, {p})', 1)} AS {n}{tail}" for n, p in (("p5", 0.05), ("p10", 0.1), ("p90", 0.9), ("p95", 0.95)))
    return f"{r(f'avg({c})', 1)} AS avg_{c}, {r(f'max({c})', 1)} AS max_{c}, {q}"


STATS_SQL = f"SELECT location_id, CAST(year(date) AS INT) AS year, season, {_stat('wetbulb', '')}, {_stat('wetbulb_avg', '_avg')} FROM {SEASONS_SQL} GROUP BY 1, 2, 3"


def yearly_sql(agg: str) -> str:
    return f"""SELECT location_id, year, season, CASE WHEN dp >= 0.95 * {NEED} THEN p END AS primary_value, CASE WHEN da >= 0.95 * {NEED} THEN a END AS average_value,
        CAST(dp AS INT) AS days_present, CAST(da AS INT) AS days_present_avg, CAST(0.95 * {NEED} AS DOUBLE) AS required_days
        FROM (SELECT location_id, CAST(year(date) AS INT) AS year, season, {agg}(wetbulb) AS p, {agg}(wetbulb_avg) AS a, count(wetbulb) AS dp, count(wetbulb_avg) AS da FROM {SEASONS_SQL} GROUP BY 1, 2, 3)"""


def long_sql(statistic: str) -> str:
    head, agg = ("max_wetbulb", "max") if statistic == "max" else ("avg_wetbulb", "avg")
    return f"""SELECT location_id, year, season, '{head}' AS metric, primary_value AS value FROM ({yearly_sql(agg)}) WHERE primary_value IS NOT NULL AND year BETWEEN 1990 AND 2025
        UNION ALL SELECT location_id, year, season, '{head}_avg', average_value FROM ({yearly_sql(agg)}) WHERE average_value IS NOT NULL AND year BETWEEN 1990 AND 2025"""


@query("v1_with_seasons", f"SELECT location_id, season, count(*) AS n, {r('sum(wetbulb)', 1)} AS total FROM {SEASONS_SQL} GROUP BY 1, 2")
def _(t):
    return stats.with_seasons(t.dense_daily).groupBy("location_id", "season").agg(F.count("*").alias("n"), rounded(F.sum("wetbulb"), 1).alias("total"))


@query("v2_year_stats", STATS_SQL)
def _(t):
    return stats.year_stats(t.dense_daily)


def _qualified(q):
    return q.withColumns({c: rounded(c, 6) for c in ("primary_value", "average_value", "required_days")})


_Q = f"SELECT location_id, year, season, {r('primary_value', 6)} AS primary_value, {r('average_value', 6)} AS average_value, days_present, days_present_avg, {r('required_days', 6)} AS required_days FROM"


@query("v3_yearly_qualified", f"{_Q} ({yearly_sql('avg')})")
def _(t):
    return _qualified(stats.yearly_qualified(t.dense_daily))


@query("v3_yearly_qualified_max", f"{_Q} ({yearly_sql('max')})")
def _(t):
    return _qualified(stats.yearly_qualified(t.dense_daily, statistic="max"))


@query("v4_unpivot_metrics", f"SELECT location_id, year, season, metric, {r('value', 6)} AS value FROM ({long_sql('mean')})")
def _(t):
    return forecast.forecast_values(t.dense_daily, statistic="mean", as_of=AS_OF).withColumn("value", rounded("value", 6))


def _told(t):
    """A small forecast table made from the last observed year, so that rankings have something to join."""
    s = stats.year_stats(t.dense_daily).where("year = 2025")
    cols = {"wetbulb": F.col("avg_wetbulb"), "lower": F.col("p10"), "upper": F.col("p90"), "wetbulb_avg": F.col("avg_wetbulb_avg"), "lower_avg": F.col("p10_avg"), "upper_avg": F.col("p90_avg")}
    out = s.select("location_id", "season", F.explode(F.array(F.lit(1990), F.lit(2100))).alias("year"), *(e.alias(c) for c, e in cols.items()))
    return out


TOLD_SQL = "SELECT location_id, season, y.year, avg_wetbulb AS wetbulb, p10 AS lower, p90 AS upper, avg_wetbulb_avg AS wetbulb_avg, p10_avg AS lower_avg, p90_avg AS upper_avg FROM st CROSS JOIN (VALUES (1990), (2100)) y(year) WHERE st.year = 2025"


def ranking_sql(where: str, base: str) -> str:
    cols = ", ".join(f"s.{x}" for x in ("location_id", "year", "season", "avg_wetbulb", "max_wetbulb", "avg_wetbulb_avg", "max_wetbulb_avg"))
    ps = ", ".join(f"s.{p}{x}" for p in ("p5", "p10", "p90", "p95") for x in ("", "_avg"))
    change = lambda c: f"CAST(round(CAST(s.{c} - b.{c} AS DECIMAL(20,6)), 2) AS DOUBLE)"
    return f"""WITH st AS ({STATS_SQL}), fc AS ({TOLD_SQL}), b AS ({base})
        SELECT {cols}, l.city, l.state, {ps}, f.lower AS future_lower, f.upper AS future_upper, f.lower_avg AS future_lower_avg, f.upper_avg AS future_upper_avg,
            {change('avg_wetbulb')} AS change_from_1990, {change('avg_wetbulb_avg')} AS change_from_1990_avg
        FROM st s JOIN {{locations}} l ON l.id = s.location_id LEFT JOIN fc f ON f.location_id = s.location_id AND f.year = 2100 AND f.season = s.season
        LEFT JOIN b ON b.location_id = s.location_id AND b.season = s.season WHERE {where}"""


SEEN = "SELECT location_id, season, avg_wetbulb, avg_wetbulb_avg FROM st WHERE year = 1990"


@query("v5_city_rankings", ranking_sql("s.location_id BETWEEN 0 AND 999", SEEN))
def _(t):
    return stats.city_rankings(stats.year_stats(t.dense_daily), t.locations, _told(t))


@query("v5_city_rankings_eu", ranking_sql("s.location_id >= 1000", SEEN))
def _(t):
    return stats.city_rankings(stats.year_stats(t.dense_daily), t.locations, _told(t), region="eu")


BLEND = """SELECT coalesce(o.location_id, f.location_id) AS location_id, coalesce(o.season, f.season) AS season, CASE WHEN o.location_id IS NULL THEN f.wetbulb ELSE o.avg_wetbulb END AS avg_wetbulb,
    CASE WHEN o.location_id IS NULL THEN f.wetbulb_avg ELSE o.avg_wetbulb_avg END AS avg_wetbulb_avg
    FROM (SELECT * FROM st WHERE year = 1990) o FULL JOIN (SELECT * FROM fc WHERE year = 1990) f ON o.location_id = f.location_id AND o.season = f.season"""


@query("v6_city_rankings_blended", ranking_sql("s.location_id BETWEEN 0 AND 999", BLEND))
def _(t):
    return stats.city_rankings_blended(stats.year_stats(t.dense_daily), t.locations, _told(t))
