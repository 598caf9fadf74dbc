"""Queries of the forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from swelter.functions.expr import rounded
from swelter.operators import forecast as fc
from swelter.operators import stats
from swelter.plans.registry import query
from swelter.plans.statistics import AS_OF, long_sql, r, yearly_sql


def _values(t, statistic="mean"):
    return fc.forecast_values(t.dense_daily, statistic=statistic, as_of=AS_OF)


def _series(t):
    """Annual means of qualified years."""
    q = stats.yearly_qualified(t.dense_daily)
    return q.where("primary_value is not null").select("location_id", "season", "year", F.col("primary_value").alias("value"))


SERIES = f"SELECT location_id, season, year, primary_value AS value FROM ({yearly_sql('avg')}) WHERE primary_value IS NOT NULL"


def _six(df, *cols):
    return df.withColumns({c: rounded(c, 6) for c in cols})


FIT1 = f"""WITH se AS ({SERIES}), m AS (SELECT location_id, season, quantile_cont(year, 0.5) AS ref FROM se GROUP BY ALL),
    f AS (SELECT se.location_id, se.season, ref, count(*) AS n, regr_slope(value, year - ref) AS c1, regr_intercept(value, year - ref) AS c0 FROM se JOIN m USING (location_id, season) GROUP BY ALL HAVING count(*) > 1),
    e AS (SELECT location_id, season, sqrt(avg(power(value - (c1 * (year - ref) + c0), 2))) AS rmse FROM se JOIN f USING (location_id, season) GROUP BY ALL)"""


@query("p1_trend_fit", f"{FIT1} SELECT location_id, season, CAST(1 AS INT) AS degree, CAST(0 AS DOUBLE) AS coef2, {r('c1', 6)} AS coef1, {r('c0', 6)} AS coef0, CAST(ref AS DOUBLE) AS reference_year, {r('rmse', 6)} AS rmse, CAST(n AS INT) AS n FROM f JOIN e USING (location_id, season)")
def _(t):
    return _six(fc.trend_fit(_series(t)), "coef1", "coef0", "rmse")


@query(
    "p1_trend_fit_quadratic",
    f"""WITH se AS ({SERIES}), m AS (SELECT location_id, season, quantile_cont(year, 0.5) AS ref FROM se GROUP BY ALL), x AS (SELECT *, year - ref AS x FROM se JOIN m USING (location_id, season)),
    s AS (SELECT location_id, season, ref, count(*) AS n, avg(x) AS mx, avg(x * x) AS mq, avg(value) AS my, var_pop(x) AS vx, var_pop(x * x) AS vq, covar_pop(x, x * x) AS cxq, covar_pop(x, value) AS cxy, covar_pop(x * x, value) AS cqy FROM x GROUP BY ALL HAVING count(*) > 2),
    f AS (SELECT *, (cqy * vx - cxy * cxq) / (vx * vq - cxq * cxq) AS c2, (cxy * vq - cqy * cxq) / (vx * vq - cxq * cxq) AS c1 FROM s), g AS (SELECT *, my - c1 * mx - c2 * mq AS c0 FROM f),
    e AS (SELECT x.location_id, x.season, sqrt(avg(power(value - (c2 * x * x + c1 * x + c0), 2))) AS rmse FROM x JOIN g ON x.location_id = g.location_id AND x.season = g.season GROUP BY ALL)
    SELECT location_id, season, CAST(2 AS INT) AS degree, {r('c2', 6)} AS coef2, {r('c1', 6)} AS coef1, {r('c0', 6)} AS coef0, CAST(ref AS DOUBLE) AS reference_year, {r('rmse', 6)} AS rmse, CAST(n AS INT) AS n FROM g JOIN e USING (location_id, season)""",
)
def _(t):
    return _six(fc.trend_fit(_series(t), degree=2), "coef2", "coef1", "coef0", "rmse")


ROLL = """ro AS (SELECT *, row_number() OVER o AS i, value - (regr_intercept(value, year) OVER b + regr_slope(value, year) OVER b * year) AS err FROM se
        WINDOW o AS (PARTITION BY location_id, season ORDER BY year), b AS (PARTITION BY location_id, season ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    cv AS (SELECT location_id, season, CASE WHEN count(*) >= 15 AND count(CASE WHEN i > 12 THEN err END) >= 5 THEN sqrt(avg(CASE WHEN i > 12 THEN err * err END)) END AS cv FROM ro GROUP BY ALL)"""


@query("p2_rolling_origin_rmse", f"WITH se AS ({SERIES}), {ROLL} SELECT location_id, season, {r('coalesce(cv, -1)', 6)} AS cv_rmse FROM cv")
def _(t):
    out = fc.rolling_origin_rmse(_series(t))
    return _six(out.withColumn("cv_rmse", F.when(F.col("cv_rmse") == float("inf"), -1.0).otherwise(F.col("cv_rmse"))), "cv_rmse")


def trend_sql(series: str) -> str:
    """CTEs that end in tf, the trend forecast of a series."""
    return f"""{FIT1.replace(SERIES, series)}, {ROLL}, la AS (SELECT location_id, season, max(year) AS last FROM se GROUP BY ALL),
    tf AS (SELECT location_id, season, CAST(y.year AS INT) AS year, c1 * (y.year - ref) + c0 AS v, greatest(rmse, coalesce(cv, 0)) * sqrt(1 + least(y.year - last, 25) / 10.0) AS sigma, n, c1
        FROM f JOIN e USING (location_id, season) JOIN cv USING (location_id, season) JOIN la USING (location_id, season) JOIN (SELECT unnest(generate_series(1991, 2100)) AS year) y ON y.year > last WHERE n >= 10 AND last < 2100)"""


_BANDS = f"{r('v', 1)} AS wetbulb{{0}}, {r('v - 1.2816 * sigma', 1)} AS lower{{0}}, {r('v + 1.2816 * sigma', 1)} AS upper{{0}}"
_TAIL = f"'linear' AS model_type, CAST(n AS INT) AS full_years_used, {r('c1', 2)} AS warming_rate, CAST(0 AS DOUBLE) AS acceleration"


@query("p3_trend_forecast", f"{trend_sql(SERIES)} SELECT location_id, season, year, {_BANDS.format('')}, {_TAIL} FROM tf")
def _(t):
    return fc.trend_forecast(_series(t))


#: A quadratic fit by covariances, its rolling errors by running ones, and the projection whose bend fades.
_QUAD = "avg(x) {0} AS mx, avg(x * x) {0} AS mq, avg(value) {0} AS my, var_pop(x) {0} AS vx, var_pop(x * x) {0} AS vq, covar_pop(x, x * x) {0} AS cxq, covar_pop(x, value) {0} AS cxy, covar_pop(x * x, value) {0} AS cqy"
_SOLVED = "(cqy * vx - cxy * cxq) / (vx * vq - cxq * cxq) AS c2, (cxy * vq - cqy * cxq) / (vx * vq - cxq * cxq) AS c1"
FORECAST2 = f"""WITH se AS ({SERIES}), m AS (SELECT location_id, season, quantile_cont(year, 0.5) AS ref, max(year) AS last, count(*) AS n FROM se GROUP BY ALL), x AS (SELECT *, year - ref AS x FROM se JOIN m USING (location_id, season)),
    f AS (SELECT *, {_SOLVED} FROM (SELECT location_id, season, ref, last, n, {_QUAD.format('')} FROM x GROUP BY ALL)), g AS (SELECT *, my - c1 * mx - c2 * mq AS c0 FROM f),
    e AS (SELECT x.location_id, x.season, sqrt(avg(power(value - (c2 * x * x + c1 * x + c0), 2))) AS rmse FROM x JOIN g ON x.location_id = g.location_id AND x.season = g.season GROUP BY ALL),
    ru AS (SELECT location_id, season, value, x, row_number() OVER (PARTITION BY location_id, season ORDER BY year) AS i, {_QUAD.format('OVER b')} FROM x WINDOW b AS (PARTITION BY location_id, season ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    rl AS (SELECT *, {_SOLVED} FROM ru WHERE i > 12), cv AS (SELECT location_id, season, count(*) AS late, sqrt(avg(power(value - (c2 * x * x + c1 * x + my - c1 * mx - c2 * mq), 2))) AS cv FROM rl GROUP BY ALL),
    y AS (SELECT g.*, CAST(year AS INT) AS year, greatest(rmse, CASE WHEN n >= 15 AND late >= 5 THEN cv ELSE 0 END) * sqrt(1 + least(year - last, 25) / 10.0 + power(least(year - last, 25) / 30.0, 2)) AS sigma, c2 * power(year - ref, 2) + c1 * (year - ref) + c0 AS raw,
        least(last + 15, 2100) AS a, least(last + 35, 2100) AS z FROM g JOIN e USING (location_id, season) LEFT JOIN cv USING (location_id, season) JOIN (SELECT unnest(generate_series(1991, 2100)) AS year) ON year > last WHERE n >= 10 AND last < 2100),
    v AS (SELECT *, CASE WHEN a < z THEN raw * (1 - least(1, greatest(0, (year - a) / (z - a)))) + (c2 * power(a - ref, 2) + c1 * (a - ref) + c0 + (year - a) * (2 * c2 * (a - ref) + c1)) * least(1, greatest(0, (year - a) / (z - a))) ELSE raw END AS v FROM y)"""


@query("p3_trend_forecast_quadratic", f"{FORECAST2} SELECT location_id, season, year, {_BANDS.format('')}, 'quadratic' AS model_type, CAST(n AS INT) AS full_years_used, {r('c1 + 2 * c2 * (year - ref)', 2)} AS warming_rate, {r('2 * c2', 3)} AS acceleration FROM v")
def _(t):
    return fc.trend_forecast(_series(t), degree=2)


def table_sql(agg: str) -> str:
    one, two = (f"SELECT location_id, season, year, {c} AS value FROM ({yearly_sql(agg)}) WHERE {c} IS NOT NULL" for c in ("primary_value", "average_value"))
    a = f"({trend_sql(one)} SELECT location_id, season, year, {_BANDS.format('')}, {_TAIL} FROM tf)"
    b = f"({trend_sql(two)} SELECT location_id, season, year, {_BANDS.format('_avg')} FROM tf)"
    return f"SELECT location_id, year, season, wetbulb, lower, upper, wetbulb_avg, lower_avg, upper_avg, model_type, full_years_used, warming_rate, acceleration FROM {a} a LEFT JOIN {b} b USING (location_id, season, year)"


@query("p4_trend_forecast_table", table_sql("avg"))
def _(t):
    return fc.trend_forecast_table(t.dense_daily)


@query("p4_trend_forecast_table_max", table_sql("max"))
def _(t):
    return fc.trend_forecast_table(t.dense_daily, statistic="max")


def gmst_sql(statistic: str) -> str:
    """CTEs lv, fi, re, po, sh: long values, fits, representatives, pooling and shrunken slopes."""
    return f"""WITH lv AS ({long_sql(statistic)}),
    fb AS (SELECT location_id, season, metric, count(*) AS n, max(v.year) AS last_year, avg(value) AS wbar, avg(anomaly) AS gbar, regr_slope(value, anomaly) AS slope, regr_sxx(value, anomaly) AS sxx, regr_syy(value, anomaly) AS syy
        FROM lv v JOIN {{gmst_obs}} g ON g.year = v.year GROUP BY ALL HAVING count(*) >= 10),
    fi AS (SELECT *, greatest(0, (syy - slope * slope * sxx) / (n - 2)) AS resv, greatest(1e-8, greatest(0, (syy - slope * slope * sxx) / (n - 2)) / sxx) AS sv FROM fb WHERE slope IS NOT NULL AND sxx > 0),
    re AS (SELECT * FROM (SELECT fi.*, station_group, row_number() OVER (PARTITION BY station_group, season, metric ORDER BY n DESC, sv, location_id) AS rk FROM fi JOIN {{station_groups}} USING (location_id)) WHERE rk = 1),
    fx AS (SELECT season, metric, count(*) AS groups, sum(1 / sv) AS w1, sum(1 / (sv * sv)) AS w2, sum(slope / sv) / sum(1 / sv) AS fm FROM re GROUP BY ALL),
    qq AS (SELECT season, metric, groups, w1, w2, sum(power(slope - fm, 2) / sv) AS q FROM re JOIN fx USING (season, metric) GROUP BY ALL),
    ta AS (SELECT season, metric, groups, CASE WHEN groups <= 1 OR w1 - w2 / w1 <= 0 THEN 0 ELSE greatest(0, (q - (groups - 1)) / (w1 - w2 / w1)) END AS tau FROM qq),
    po AS (SELECT season, metric, groups, tau, sum(slope / (sv + tau)) / sum(1 / (sv + tau)) AS pm, greatest(1e-8, 1 / sum(1 / (sv + tau))) AS pv FROM re JOIN ta USING (season, metric) GROUP BY ALL),
    sh AS (SELECT fi.*, tau, CASE WHEN tau <= 0 THEN pm ELSE (slope / sv + pm / tau) / (1 / sv + 1 / tau) END AS ss, CASE WHEN tau <= 0 THEN pv ELSE greatest(1e-8, 1 / (1 / sv + 1 / tau)) END AS ssv FROM fi JOIN po USING (season, metric))"""


def _fits(t):
    return fc.gmst_fit(_values(t), t.gmst_obs)


_FIT_COLS = ("wbar", "gbar", "slope", "residual_variance", "slope_variance")


@query("p5_gmst_fit", f"{gmst_sql('mean')} SELECT location_id, season, metric, CAST(n AS INT) AS n, last_year, {r('wbar', 6)} AS wbar, {r('gbar', 6)} AS gbar, {r('slope', 6)} AS slope, {r('resv', 6)} AS residual_variance, {r('sv', 6)} AS slope_variance FROM fi")
def _(t):
    return _six(_fits(t), *_FIT_COLS)


@query("p6_group_representatives", f"{gmst_sql('mean')} SELECT station_group, season, metric, location_id, CAST(n AS INT) AS n, {r('slope', 6)} AS slope FROM re")
def _(t):
    return _six(fc.group_representatives(_fits(t), t.station_groups), "slope").select("station_group", "season", "metric", "location_id", "n", "slope")


@query("p7_random_effects_pool", f"{gmst_sql('mean')} SELECT season, metric, CAST(groups AS INT) AS groups, {r('tau', 6)} AS tau_squared, {r('pm', 6)} AS pooled_mean, {r('pv', 6)} AS pooled_variance, CASE WHEN groups <= 1 THEN 'single_group' WHEN tau <= 0 THEN 'fixed' ELSE 'none' END AS fallback FROM po")
def _(t):
    return _six(fc.random_effects_pool(fc.group_representatives(_fits(t), t.station_groups)), "tau_squared", "pooled_mean", "pooled_variance")


@query("p8_shrink_slopes", f"{gmst_sql('mean')} SELECT location_id, season, metric, {r('ss', 6)} AS slope_star, {r('ssv', 6)} AS slope_star_variance FROM sh")
def _(t):
    fits = _fits(t)
    out = fc.shrink_slopes(fits, fc.random_effects_pool(fc.group_representatives(fits, t.station_groups)))
    return _six(out, "slope_star", "slope_star_variance").select("location_id", "season", "metric", "slope_star", "slope_star_variance")


def gmst_forecast_sql(statistic: str) -> str:
    pick = lambda e, avg: f"max(CASE WHEN metric {'' if avg else 'NOT '}LIKE '%\\_avg' ESCAPE '\\' THEN {e} END)"
    cols = ", ".join(f"{r(pick(e, avg), 1)} AS {c}{'_avg' if avg else ''}" for avg in (False, True) for c, e in (("wetbulb", "point"), ("lower", "point - margin"), ("upper", "point + margin")))
    return f"""{gmst_sql(statistic)},
    fl AS (SELECT location_id, s.year, season, metric, s.scenario, n, wbar + ss * (s.anomaly - gbar) AS point, calibration_factor * 1.2816 * sqrt(greatest(0, resv * (1 + 1.0 / n) + ssv * power(s.anomaly - gbar, 2) + ss * ss * sigma_g * sigma_g)) AS margin, s.anomaly - pr.anomaly AS wr
        FROM sh JOIN {{gmst_scen}} s ON s.year > last_year LEFT JOIN (SELECT scenario, year, anomaly FROM {{gmst_scen}}) pr ON pr.scenario = s.scenario AND pr.year = s.year - 1 JOIN {{calib}} USING (metric))
    SELECT location_id, CAST(year AS INT) AS year, season, scenario, {cols}, 'gmst_linear' AS model_type, CAST({pick('n', False)} AS INT) AS full_years_used, {r('max(wr)', 6)} AS warming_rate, CAST(0 AS DOUBLE) AS acceleration FROM fl GROUP BY location_id, year, season, scenario"""


def _gmst(t, statistic):
    return fc.gmst_forecast(_values(t, statistic), t.gmst_obs, t.gmst_scen, t.station_groups, t.calib)


@query("p9_gmst_forecast", gmst_forecast_sql("mean"))
def _(t):
    return _six(_gmst(t, "mean"), "warming_rate")


@query("p9_gmst_forecast_max", gmst_forecast_sql("max"))
def _(t):
    return _six(_gmst(t, "max"), "warming_rate")


@query("p10_gmst_forecast_tables", f"SELECT * EXCLUDE (scenario), 'forecast' AS table_name FROM ({gmst_forecast_sql('mean')}) WHERE scenario = 'ssp245' UNION ALL SELECT * EXCLUDE (scenario), 'forecast_max' FROM ({gmst_forecast_sql('max')}) WHERE scenario = 'ssp245'")
def _(t):
    tables = fc.gmst_forecast_tables(_gmst(t, "mean"), _gmst(t, "max"))
    out = [tables[n].withColumn("table_name", F.lit(n)) for n in ("forecast", "forecast_max")]
    return _six(out[0].unionByName(out[1]), "warming_rate")


#: A long series of yearly anomalies with the shape of an observed record, from order counts per customer key.
RECORD = "SELECT CAST(1850 + c_custkey % 176 AS INT) AS year, count(*) AS c, sum(c_custkey * 37 % 101) AS s FROM {customer} GROUP BY 1"
RECORD_SQL = f"SELECT year, CAST(s % 500 + (year - 1850) * 6 AS DOUBLE) / 1000 AS anomaly, CAST(s % 500 + (year - 1850) * 6 - 80 AS DOUBLE) / 1000 AS anomaly_lo, CAST(s % 500 + (year - 1850) * 6 + 90 AS DOUBLE) / 1000 AS anomaly_hi FROM ({RECORD})"
REBASED = f"SELECT year, anomaly - b AS anomaly, anomaly_lo - b AS anomaly_lo, anomaly_hi - b AS anomaly_hi FROM ({RECORD_SQL}) CROSS JOIN (SELECT avg(anomaly) AS b FROM ({RECORD_SQL}) WHERE year BETWEEN 1850 AND 1900) WHERE year <= 2025"


def _record(t):
    return t.spark.sql(RECORD_SQL, customer=t.customer)


@query("p11_rebase_anomalies", f"SELECT year, {r('anomaly', 6)} AS anomaly, {r('anomaly_lo', 6)} AS anomaly_lo, {r('anomaly_hi', 6)} AS anomaly_hi FROM ({REBASED})")
def _(t):
    return _six(fc.rebase_anomalies(_record(t), end_year=2025), "anomaly", "anomaly_lo", "anomaly_hi")


_KNOTS = ", ".join(f"('{s}', {y}, {v[0]}, {v[1]}, {v[2]})" for s, by in fc.ASSESSED.items() for y, v in by.items())


@query(
    "p12_build_scenarios",
    f"""WITH ob AS ({REBASED}), an AS (SELECT avg(anomaly) AS a FROM ob WHERE year BETWEEN 2015 AND 2025), kn(scenario, year, anomaly, anomaly_lo, anomaly_hi) AS (VALUES {_KNOTS}),
    pt AS (SELECT * FROM kn UNION ALL SELECT DISTINCT scenario, 2020, a, a, a FROM kn CROSS JOIN an),
    sg AS (SELECT scenario, year AS l, anomaly AS la, anomaly_lo AS ll, anomaly_hi AS lh, lead(year) OVER w AS r, lead(anomaly) OVER w AS ra, lead(anomaly_lo) OVER w AS rl, lead(anomaly_hi) OVER w AS rh FROM pt WINDOW w AS (PARTITION BY scenario ORDER BY year)),
    tr AS (SELECT anomaly, CASE WHEN count(anomaly) OVER w >= 3 THEN avg(anomaly) OVER w END AS t FROM ob WHERE year BETWEEN 1990 AND 2025 WINDOW w AS (ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
    si AS (SELECT stddev_samp(anomaly - t) AS s FROM tr), ys AS (SELECT CAST(unnest(generate_series(2026, 2100)) AS INT) AS y)
    SELECT scenario, y AS year, {r('la + (y - l) * (ra - la) / (r - l)', 6)} AS anomaly, {r('ll + (y - l) * (rl - ll) / (r - l)', 6)} AS anomaly_lo, {r('lh + (y - l) * (rh - lh) / (r - l)', 6)} AS anomaly_hi, {r('s', 6)} AS sigma_g
    FROM sg JOIN ys ON y > l AND (y <= r OR r = 2090) CROSS JOIN si WHERE r IS NOT NULL""",
)
def _(t):
    obs = fc.rebase_anomalies(_record(t), end_year=2025)
    return _six(fc.build_scenarios(obs, fc.scenario_knots(t.spark), end_year=2025), "anomaly", "anomaly_lo", "anomaly_hi", "sigma_g")
