"""Queries of the backtest."""

from __future__ import annotations


from pyspark.sql import functions as F

from swelter.functions.expr import rounded
from swelter.operators import backtest as bt
from swelter.plans.registry import query
from swelter.plans.statistics import NEED, SEASON, r

#: Origins of the queries and their SQL: the full range, as in the operator.
ORIGINS = range(2009, 2025)

_ONE = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id, date ORDER BY CASE WHEN source = 'isd' THEN 0 ELSE 1 END, wetbulb DESC, wetbulb_avg DESC, source) AS rk FROM {dense_daily}) WHERE rk = 1)"
ANNUAL = f"""SELECT location_id, year, season, CAST(dp AS INT) AS days_present, CASE WHEN dp >= 0.95 * {NEED} THEN a1 END AS avg_wetbulb, CASE WHEN dp >= 0.95 * {NEED} THEN m1 END AS max_wetbulb,
    CAST(da AS INT) AS days_present_avg, CASE WHEN da >= 0.95 * {NEED} THEN a2 END AS avg_wetbulb_avg, CASE WHEN da >= 0.95 * {NEED} THEN m2 END AS max_wetbulb_avg
    FROM (SELECT location_id, CAST(year(date) AS INT) AS year, season, count(wetbulb) AS dp, avg(wetbulb) AS a1, max(wetbulb) AS m1, count(wetbulb_avg) AS da, avg(wetbulb_avg) AS a2, max(wetbulb_avg) AS m2
    FROM (SELECT *, 'Annual' AS season FROM {_ONE} UNION ALL SELECT *, {SEASON} FROM {_ONE}) GROUP BY 1, 2, 3)"""


@query("b1_annual_metrics", f"SELECT location_id, year, season, days_present, {r('avg_wetbulb', 6)} AS avg_wetbulb, {r('max_wetbulb', 6)} AS max_wetbulb, days_present_avg, {r('avg_wetbulb_avg', 6)} AS avg_wetbulb_avg, {r('max_wetbulb_avg', 6)} AS max_wetbulb_avg FROM ({ANNUAL})")
def _(t):
    return bt.annual_metrics(t.fine().dense_daily).withColumns({c: rounded(c, 6) for c in bt.METRICS})


def cases_sql(oracle: bool = False) -> str:
    """CTEs that end in ca, the cases."""
    predictor = "g.anomaly" if oracle else "ga + gs * (a.year - gy)"
    variance = "0" if oracle else "greatest(0, gres * (1 + 1.0 / gn + power(a.year - gy, 2) / gx))"
    return f"""WITH an AS ({ANNUAL}), ori AS (SELECT CAST(unnest(generate_series({ORIGINS[0]}, {ORIGINS[-1]})) AS INT) AS origin),
    lv AS (SELECT location_id, year, season, metric, value + CAST((location_id * 31 + year * 17) % 13 AS DOUBLE) / 10 AS value FROM an UNPIVOT (value FOR metric IN (avg_wetbulb, max_wetbulb, avg_wetbulb_avg, max_wetbulb_avg))),
    tr AS (SELECT lv.*, origin FROM lv JOIN ori ON year <= origin WHERE year >= 2000),
    fb AS (SELECT location_id, origin, season, metric, count(*) AS n, avg(value) AS wbar, avg(anomaly) AS gbar, regr_slope(value, anomaly) AS slope, regr_sxx(value, anomaly) AS sxx, regr_syy(value, anomaly) AS syy, avg(tr.year) AS ybar, regr_slope(value, tr.year) AS per
        FROM tr JOIN {{gmst_obs}} g ON g.year = tr.year GROUP BY ALL HAVING count(*) >= 10),
    fi AS (SELECT *, greatest(0, (syy - slope * slope * sxx) / (n - 2)) AS resv, greatest(1e-8, greatest(0, (syy - slope * slope * sxx) / (n - 2)) / sxx) AS sv FROM fb WHERE slope IS NOT NULL AND sxx > 0),
    re AS (SELECT * FROM (SELECT fi.*, station_group, row_number() OVER (PARTITION BY station_group, origin, season, metric ORDER BY n DESC, sv, location_id) AS rk FROM fi JOIN {{station_groups}} USING (location_id)) WHERE rk = 1),
    fx AS (SELECT origin, season, metric, count(*) AS groups, sum(1 / sv) AS w1, sum(1 / (sv * sv)) AS w2, sum(slope / sv) / sum(1 / sv) AS fm FROM re GROUP BY ALL),
    qq AS (SELECT origin, season, metric, groups, w1, w2, sum(power(slope - fm, 2) / sv) AS q FROM re JOIN fx USING (origin, season, metric) GROUP BY ALL),
    ta AS (SELECT origin, season, metric, CASE WHEN groups <= 1 OR w1 - w2 / w1 <= 0 THEN 0 ELSE greatest(0, (q - (groups - 1)) / (w1 - w2 / w1)) END AS tau FROM qq),
    po AS (SELECT origin, season, metric, tau, sum(slope / (sv + tau)) / sum(1 / (sv + tau)) AS pm, greatest(1e-8, 1 / sum(1 / (sv + tau))) AS pv FROM re JOIN ta USING (origin, season, metric) GROUP BY ALL),
    sh AS (SELECT fi.*, CASE WHEN tau <= 0 THEN pm ELSE (slope / sv + pm / greatest(tau, 1e-8)) / (1 / sv + 1 / greatest(tau, 1e-8)) END AS ss, CASE WHEN tau <= 0 THEN pv ELSE greatest(1e-8, 1 / (1 / sv + 1 / greatest(tau, 1e-8))) END AS ssv FROM fi JOIN po USING (origin, season, metric)),
    gt AS (SELECT origin, count(*) AS gn, avg(year) AS gy, avg(anomaly) AS ga, regr_slope(anomaly, year) AS gs, regr_sxx(anomaly, year) AS gx, regr_syy(anomaly, year) AS gyy FROM {{gmst_obs}} JOIN ori ON year <= origin WHERE year >= 2000 GROUP BY origin),
    gr AS (SELECT *, greatest(0, (gyy - gs * gs * gx) / (gn - 2)) AS gres FROM gt),
    pr AS (SELECT a.location_id, station_group, sh.origin, a.year, a.year - sh.origin AS horizon, a.metric, a.season, a.value AS actual, wbar, gbar, ss, ssv, resv, n, {predictor} AS x, {variance} AS xv, wbar + per * (a.year - ybar) AS legacy
        FROM lv a JOIN sh ON sh.location_id = a.location_id AND sh.season = a.season AND sh.metric = a.metric AND a.year > sh.origin AND a.year <= sh.origin + 10
        JOIN {{station_groups}} sg ON sg.location_id = a.location_id JOIN gr ON gr.origin = sh.origin JOIN {{gmst_obs}} g ON g.year = a.year),
    ca AS (SELECT location_id, station_group, origin, year, CAST(horizon AS INT) AS horizon, metric, season, actual, wbar + ss * (x - gbar) AS gmst, legacy,
        1.2816 * sqrt(greatest(0, resv * (1 + 1.0 / n) + ssv * power(x - gbar, 2) + ss * ss * xv)) AS margin FROM pr)"""


def _cases(t, oracle=False, origins=ORIGINS):
    noise = ((F.col("location_id") * 31 + F.col("year") * 17) % 13).cast("double") / 10  # else the yearly maxima lie on a line
    annual = bt.annual_metrics(t.fine().dense_daily).withColumns({c: F.col(c) + noise for c in bt.METRICS})
    return bt.backtest_cases(annual, t.gmst_obs, t.station_groups, origins=origins, oracle=oracle)


_CASE = f"SELECT location_id, station_group, origin, year, horizon, metric, season, {r('actual', 6)} AS actual, {r('gmst', 6)} AS gmst, {r('legacy', 6)} AS legacy, {r('gmst - margin', 6)} AS lower, {r('gmst + margin', 6)} AS upper"
_FIVE = ("actual", "gmst", "legacy", "lower", "upper")


@query("b2_backtest_cases", f"{cases_sql()} {_CASE}, false AS oracle FROM ca")
def _(t):
    return _cases(t).withColumns({c: rounded(c, 6) for c in _FIVE})


@query("b2_backtest_cases_oracle", f"{cases_sql(True)} {_CASE}, true AS oracle FROM ca")
def _(t):
    return _cases(t, True).withColumns({c: rounded(c, 6) for c in _FIVE})


GATES = range(2012, 2025)
FACTORS = f"""gates AS (SELECT CAST(unnest(generate_series({GATES[0]}, {GATES[-1]})) AS INT) AS gate),
    kn AS (SELECT * FROM (SELECT gate, metric, abs(actual - gmst) / greatest(margin, 2.220446049250313e-16) AS score, row_number() OVER (PARTITION BY gate, station_group, origin, year, metric ORDER BY location_id) AS rk
        FROM ca JOIN gates ON origin < gate AND year <= gate WHERE season = 'Annual') WHERE rk = 1),
    rk AS (SELECT gate, metric, score, count(*) OVER (PARTITION BY gate, metric) AS n, row_number() OVER (PARTITION BY gate, metric ORDER BY score) AS i FROM kn),
    fa AS (SELECT g.gate, m.metric, coalesce(CASE WHEN n >= 100 THEN greatest(score, 1) END, 1) AS factor FROM gates g CROSS JOIN (VALUES ('avg_wetbulb'), ('max_wetbulb'), ('avg_wetbulb_avg'), ('max_wetbulb_avg')) m(metric)
        LEFT JOIN (SELECT * FROM rk WHERE i = ceil(round(0.7 * (n - 1), 9)) + 1) x ON x.gate = g.gate AND x.metric = m.metric)"""


@query("b3_calibration_factors", f"{cases_sql()}, {FACTORS} SELECT gate AS origin, metric, {r('factor', 6)} AS factor FROM fa")
def _(t):
    gates = t.spark.createDataFrame([(o,) for o in GATES], "origin int")
    return bt.calibration_factors(_cases(t), gates).withColumn("factor", rounded("factor", 6))


CALIBRATED = f"{cases_sql()}, {FACTORS}, cb AS (SELECT ca.*, factor, gmst - margin * factor AS lo, gmst + margin * factor AS hi FROM ca JOIN fa ON fa.gate = ca.origin AND fa.metric = ca.metric)"


def _calibrated(t):
    return bt.calibrate_intervals(_cases(t), gate_origins=GATES)


@query("b4_calibrate_intervals", f"{CALIBRATED} SELECT location_id, origin, year, metric, season, {r('lo', 6)} AS lower, {r('hi', 6)} AS upper, {r('factor', 6)} AS calibration_factor FROM cb")
def _(t):
    out = _calibrated(t).withColumns({c: rounded(c, 6) for c in ("lower", "upper", "calibration_factor")})
    return out.select("location_id", "origin", "year", "metric", "season", "lower", "upper", "calibration_factor")


_RATIO = f"{r('avg(abs(gmst - actual)) / avg(abs(legacy - actual))', 6)} AS mae_ratio, {r('sqrt(avg(power(gmst - actual, 2)) / avg(power(legacy - actual, 2)))', 6)} AS rmse_ratio, {r('avg(CASE WHEN actual BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END)', 6)} AS coverage_80"


@query(
    "b5_evaluate_gate",
    f"""{CALIBRATED}, ga AS (SELECT metric, {_RATIO}, {r('min(factor)', 6)} AS factor_min, {r('max(factor)', 6)} AS factor_max, count(*) AS n FROM cb WHERE season = 'Annual' AND horizon BETWEEN 5 AND 10 GROUP BY ROLLUP (metric))
    SELECT *, (SELECT bool_and(CASE WHEN metric IS NULL THEN mae_ratio <= 1.02 AND rmse_ratio <= 1.02 ELSE mae_ratio <= 1.05 AND rmse_ratio <= 1.05 AND coverage_80 BETWEEN 0.75 AND 0.85 END) FROM ga) AS passed FROM ga""",
)
def _(t):
    return bt.evaluate_gate(_calibrated(t)).withColumns({c: rounded(c, 6) for c in ("mae_ratio", "rmse_ratio", "coverage_80", "factor_min", "factor_max")})


@query("b6_seasonal_diagnostics", f"{CALIBRATED} SELECT season, metric, {_RATIO}, count(*) AS n FROM cb WHERE horizon BETWEEN 5 AND 10 GROUP BY 1, 2")
def _(t):
    return bt.seasonal_diagnostics(_calibrated(t)).withColumns({c: rounded(c, 6) for c in ("mae_ratio", "rmse_ratio", "coverage_80")})


_BOUNDS = ", ".join(r(f"quantile_cont({c}, {p})", 6) + f" AS {c}_ratio_{n}" for c in ("mae", "rmse") for p, n in ((0.025, "low"), (0.975, "high")))


@query(
    "b7_bootstrap_ratios",
    f"""{CALIBRATED}, er AS (SELECT metric AS m, station_group, sum(abs(gmst - actual)) AS a, sum(abs(legacy - actual)) AS b, sum(power(gmst - actual, 2)) AS c, sum(power(legacy - actual, 2)) AS d FROM cb WHERE season = 'Annual' AND horizon BETWEEN 5 AND 10 GROUP BY 1, 2),
    al AS (SELECT * FROM er UNION ALL SELECT '', station_group, sum(a), sum(b), sum(c), sum(d) FROM er GROUP BY station_group),
    nu AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY station_group) - 1 AS i, count(*) OVER (PARTITION BY m) AS g FROM al),
    dr AS (SELECT m, k, CAST('0x' || substr(md5('0|' || k || '|' || m || '|' || n), 1, 8) AS BIGINT) % g AS i FROM (SELECT DISTINCT m, g, unnest(generate_series(1, g)) AS n FROM nu) CROSS JOIN (SELECT unnest(generate_series(0, 999)) AS k)),
    ea AS (SELECT m, k, sum(a) / sum(b) AS mae, sqrt(sum(c) / sum(d)) AS rmse FROM dr JOIN nu USING (m, i) GROUP BY 1, 2)
    SELECT nullif(m, '') AS metric, {_BOUNDS} FROM ea GROUP BY m""",
)
def _(t):
    out = bt.bootstrap_ratios(_calibrated(t))
    return out.select("metric", *(rounded(c, 6).alias(c) for c in out.columns[1:]))
