"""Trend and climate-informed forecasts: window and regression aggregates over yearly values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swelter.functions.expr import rounded
from swelter.operators.stats import unpivot_metrics, yearly_qualified

Z80 = 1.2816
FLOOR = 1e-8
#: Assessed warming (best, low, high) by scenario and year (fixed values).
ASSESSED = {
    "ssp126": {2030: (1.5, 1.2, 1.8), 2050: (1.7, 1.3, 2.2), 2090: (1.8, 1.3, 2.4)},
    "ssp245": {2030: (1.5, 1.2, 1.8), 2050: (2.0, 1.6, 2.5), 2090: (2.7, 2.1, 3.5)},
    "ssp370": {2030: (1.5, 1.2, 1.8), 2050: (2.1, 1.7, 2.6), 2090: (3.6, 2.8, 4.6)},
}


def _keys(series: DataFrame) -> list[str]:
    return [c for c in series.columns if c not in ("year", "value")]


def _power_sums(x: Column, y: Column, degree: int, over=None) -> dict[str, Column]:
    """Sums of powers of x, and of those times y, over the rows with a y: all that a fit needs, whichever way the rows are added up."""
    x = F.when(y.isNotNull(), x)
    terms = {f"s{k}": F.pow(x, F.lit(float(k))) for k in range(2 * degree + 1)} | {f"t{k}": F.pow(x, F.lit(float(k))) * y for k in range(degree + 1)}
    return {c: F.sum(e).over(over) if over is not None else F.sum(e) for c, e in terms.items()}


def _coefficients(name, degree: int) -> list[Column]:
    """Constant, slope (and square) from the sums in the columns ``name(...)``; null without a unique solution."""
    s, t = [F.col(name(f"s{k}")) for k in range(2 * degree + 1)], [F.col(name(f"t{k}")) for k in range(degree + 1)]

    def determinant(a) -> Column:
        if len(a) == 2:
            return a[0][0] * a[1][1] - a[0][1] * a[1][0]
        return sum((a[0][i] * determinant([[r[j] for j in range(3) if j != i] for r in a[1:]]) * (-1) ** i for i in range(3)), F.lit(0.0))

    rows = [[s[i + j] for j in range(degree + 1)] for i in range(degree + 1)]
    whole = determinant(rows)
    solved = [determinant([[t[i] if j == k else rows[i][j] for j in range(degree + 1)] for i in range(degree + 1)]) for k in range(degree + 1)]
    return [F.when((s[0] > degree) & (F.abs(whole) >= 1e-12), x / whole) for x in solved]


def trend_states(rows: DataFrame, keys: list[str], metrics: list[str], *, degree: int = 1, min_train: int = 12) -> DataFrame:
    """One row per key with what trends of its metrics need, from yearly rows (keys, year, metrics; null where a metric has no value).

    For each metric m: m_n, m_last (year), m_ref (median year), m_c0, m_c1, m_c2 (around m_ref; null without a unique fit), m_rmse, and
    of the errors of predicting each year after the first ``min_train`` from those before it their number and mean square, m_late and
    m_late_sq. Fits come from power sums, the predictions from running ones in the order of years: one pass for all metrics."""
    if degree not in (1, 2):
        raise ValueError(f"degree {degree} is not supported")
    key = Window.partitionBy(*keys)
    before = key.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(*keys, "year", *metrics).withColumn("_c", F.round(F.avg("year").over(key))).withColumn("_x", F.col("year") - F.col("_c"))
    powers = lambda a, x: sum((c * F.pow(x, F.lit(float(k))) for k, c in enumerate(a)), F.lit(0.0))
    for m in metrics:
        part = lambda c, m=m: f"_{m}_{c}"
        rows = rows.withColumns({part(c): e for c, e in _power_sums(F.col("_x"), F.col(m), degree, before).items()})
        late = F.when(F.coalesce(F.col(part("s0")), F.lit(0.0)) >= min_train, F.col(m) - powers(_coefficients(part, degree), F.col("_x")))
        rows = rows.withColumn(part("e"), late).drop(*(part(c) for c in _power_sums(F.col("_x"), F.col(m), degree)))
    sums = [F.first("_c").alias("_c")]
    for m in metrics:
        y = F.col(m)
        year = F.when(y.isNotNull(), F.col("year"))
        sums += [e.alias(f"_{m}_{c}") for c, e in _power_sums(F.col("_x"), y, degree).items()]
        sums += [F.count(m).alias(f"{m}_n"), F.max(year).alias(f"{m}_last"), F.percentile(year, 0.5).alias(f"{m}_ref"), F.sum(y * y).alias(f"_{m}_yy")]
        sums += [F.count(f"_{m}_e").alias(f"{m}_late"), F.avg(F.col(f"_{m}_e") * F.col(f"_{m}_e")).alias(f"{m}_late_sq")]
    out = rows.groupBy(*keys).agg(*sums)
    for m in metrics:
        part = lambda c, m=m: f"_{m}_{c}"
        out = out.withColumns({part(f"a{k}"): e for k, e in enumerate(_coefficients(part, degree))})
        a = [F.col(part(f"a{k}")) for k in range(degree + 1)]
        rest = F.col(f"_{m}_yy") - sum((c * F.col(part(f"t{k}")) for k, c in enumerate(a)), F.lit(0.0))
        d = F.col(f"{m}_ref") - F.col("_c")
        square = a[2] if degree == 2 else F.lit(0.0)
        out = out.withColumns({f"{m}_c2": square, f"{m}_c1": a[1] + 2 * square * d, f"{m}_c0": powers(a, d), f"{m}_rmse": F.sqrt(F.greatest(F.lit(0.0), rest) / F.col(f"{m}_n"))})
    kept = ("n", "last", "ref", "c0", "c1", "c2", "rmse", "late", "late_sq")
    return out.select(*keys, *(f"{m}_{c}" for m in metrics for c in kept))


def trend_fit(series: DataFrame, *, degree: int = 1) -> DataFrame:
    """Least squares of value on year, centred on the median year, per key; no row where it has no unique solution."""
    keys = _keys(series)
    out = trend_states(series, keys, ["value"], degree=degree).where("value_c1 is not null")
    return out.select(*keys, F.lit(degree).alias("degree"), *(F.col(f"value_c{k}").alias(f"coef{k}") for k in (2, 1, 0)), F.col("value_ref").alias("reference_year"), F.col("value_rmse").alias("rmse"), F.col("value_n").cast("int").alias("n"))


def _rolling_error(m: str, min_train: int = 12, min_errors: int = 5) -> Column:
    good = (F.col(f"{m}_n") >= min_train + 3) & (F.col(f"{m}_late") >= min_errors)
    return F.when(good, F.sqrt(f"{m}_late_sq")).otherwise(float("inf"))


def rolling_origin_rmse(series: DataFrame, *, degree: int = 1, min_train: int = 12, min_errors: int = 5) -> DataFrame:
    """Error of predicting each year from a fit to all years before it; infinite with too few years or errors."""
    keys = _keys(series)
    out = trend_states(series, keys, ["value"], degree=degree, min_train=min_train)
    return out.select(*keys, _rolling_error("value", min_train, min_errors).alias("cv_rmse"))


#: Years after the last one between which the bend of a quadratic trend fades into its tangent.
FADE = (15, 35)


def _projected(m: str, degree: int, end_year: int, z: float) -> dict[str, Column]:
    """wetbulb, lower and upper of a metric's trend in the column ``year``."""
    year, last, ref = F.col("year"), F.col(f"{m}_last"), F.col(f"{m}_ref")
    c0, c1, c2 = (F.col(f"{m}_c{k}") for k in range(3))
    at = lambda y: c2 * F.pow(y - ref, F.lit(2.0)) + c1 * (y - ref) + c0
    ahead = F.least(year - last, F.lit(25))
    value, grown = at(year), 1 + ahead / 10.0
    if degree == 2:
        begin, end = (F.least(last + k, F.lit(end_year)) for k in FADE)
        tangent = at(begin) + (year - begin) * (2 * c2 * (begin - ref) + c1)
        weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(year - begin, end - begin)))
        value = F.when(begin < end, value * (1 - weight) + tangent * weight).otherwise(value)
        grown = grown + F.pow(ahead / 30.0, F.lit(2.0))
    cv = _rolling_error(m)
    sigma = F.greatest(f"{m}_rmse", F.when(cv < float("inf"), cv).otherwise(0.0)) * F.sqrt(grown)
    return {"wetbulb": rounded(value, 1), "lower": rounded(value - z * sigma, 1), "upper": rounded(value + z * sigma, 1)}


def _forecast_rows(states: DataFrame, m: str, end_year: int, min_years: int) -> DataFrame:
    good = (F.col(f"{m}_n") >= min_years) & F.col(f"{m}_c1").isNotNull() & (F.col(f"{m}_last") < end_year)
    return states.where(good).withColumn("year", F.explode(F.sequence((F.col(f"{m}_last") + 1).cast("int"), F.lit(end_year))))


def _described(m: str, degree: int) -> list[Column]:
    slope = F.col(f"{m}_c1") + 2 * F.col(f"{m}_c2") * (F.col("year") - F.col(f"{m}_ref"))
    return [F.lit("quadratic" if degree == 2 else "linear").alias("model_type"), F.col(f"{m}_n").cast("int").alias("full_years_used"), rounded(slope, 2).alias("warming_rate"), rounded(2 * F.col(f"{m}_c2"), 3).alias("acceleration")]


def trend_forecast(series: DataFrame, *, degree: int = 1, end_year: int = 2100, min_years: int = 10, z: float = Z80) -> DataFrame:
    """Trend per key carried to ``end_year`` with bands that widen for 25 years.

    A quadratic trend bends for 15 years, then fades into its tangent there over 20 more; its bands widen faster."""
    keys = _keys(series)
    years = _forecast_rows(trend_states(series, keys, ["value"], degree=degree), "value", end_year, min_years)
    return years.select(*keys, "year", *(e.alias(c) for c, e in _projected("value", degree, end_year, z).items()), *_described("value", degree))


def trend_forecast_table(daily: DataFrame, *, statistic: str = "mean", degree: int = 1, end_year: int = 2100, min_years: int = 10, z: float = Z80) -> DataFrame:
    """Trend forecasts of both metrics side by side; the second is null where it has too few years.

    The daily table is read and shuffled once: both metrics' trends come from one pass over the years of a location."""
    keys, metrics = ["location_id", "season"], ["primary_value", "average_value"]
    states = trend_states(yearly_qualified(daily, statistic=statistic), keys, metrics, degree=degree)
    years = _forecast_rows(states, "primary_value", end_year, min_years)
    second = (F.col("average_value_n") >= min_years) & F.col("average_value_c1").isNotNull() & (F.col("average_value_last") < F.col("year"))
    first = _projected("primary_value", degree, end_year, z)
    beside = {f"{c}_avg": F.when(second, e) for c, e in _projected("average_value", degree, end_year, z).items()}
    return years.select("location_id", "year", "season", *(e.alias(c) for c, e in (first | beside).items()), *_described("primary_value", degree))


def gmst_fit(values: DataFrame, gmst: DataFrame, *, keys=("location_id", "season", "metric"), min_n: int = 10, more=()) -> DataFrame:
    """Regression of yearly values on the global temperature anomaly; ``more`` are further aggregates of the same rows."""
    joined = values.join(F.broadcast(gmst.select("year", "anomaly")), "year")
    fit = joined.groupBy(*keys).agg(
        F.count("*").cast("int").alias("n"),
        F.max("year").alias("last_year"),
        F.avg("value").alias("wbar"),
        F.avg("anomaly").alias("gbar"),
        F.regr_slope("value", "anomaly").alias("slope"),
        F.regr_sxx("value", "anomaly").alias("sxx"),
        F.regr_syy("value", "anomaly").alias("syy"),
        *more,
    )
    fit = fit.where((F.col("n") >= max(min_n, 3)) & F.col("slope").isNotNull() & (F.col("sxx") > 0))
    rest = F.greatest(F.lit(0.0), (F.col("syy") - F.pow("slope", F.lit(2)) * F.col("sxx")) / (F.col("n") - 2))
    fit = fit.withColumn("residual_variance", rest)
    return fit.withColumn("slope_variance", F.greatest(F.lit(FLOOR), F.col("residual_variance") / F.col("sxx"))).drop("sxx", "syy")


def _significant(c: str, digits: int = 9) -> Column:
    """A positive value to so many digits: variances that differ only by the order in which values were added up are equal again."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(c)) - (digits - 1))
    return F.round(F.col(c) / unit) * unit


def group_representatives(fits: DataFrame, groups: DataFrame, *, keys=("season", "metric")) -> DataFrame:
    """One fit per station group: most years, then least variance (to nine digits), then smallest id."""
    best = Window.partitionBy("station_group", *keys).orderBy(F.desc("n"), _significant("slope_variance"), "location_id")
    rows = fits if "station_group" in fits.columns else fits.join(groups, "location_id")
    return rows.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def random_effects_pool(reps: DataFrame, *, keys=("season", "metric")) -> DataFrame:
    """DerSimonian-Laird pooling of the representatives' slopes."""
    keys = list(keys)
    w = 1 / F.col("slope_variance")
    fixed = reps.groupBy(*keys).agg(F.count("*").cast("int").alias("groups"), F.sum(w).alias("w1"), F.sum(w * w).alias("w2"), (F.sum(F.col("slope") * w) / F.sum(w)).alias("fixed_mean"))
    q = reps.join(fixed, keys).groupBy(*keys, "groups", "w1", "w2").agg(F.sum(w * F.pow(F.col("slope") - F.col("fixed_mean"), 2)).alias("q"))
    spread = F.col("w1") - F.col("w2") / F.col("w1")
    one = (F.col("groups") <= 1) | (spread <= 0)
    tau = q.select(*keys, "groups", F.when(one, 0.0).otherwise(F.greatest(F.lit(0.0), F.try_divide(F.col("q") - (F.col("groups") - 1), spread))).alias("tau_squared"))
    v = 1 / (F.col("slope_variance") + F.col("tau_squared"))
    out = reps.join(tau, keys).groupBy(*keys, "groups", "tau_squared").agg((F.sum(F.col("slope") * v) / F.sum(v)).alias("pooled_mean"), F.greatest(F.lit(FLOOR), 1 / F.sum(v)).alias("pooled_variance"))
    return out.withColumn("fallback", F.when(F.col("groups") <= 1, "single_group").when(F.col("tau_squared") <= 0, "fixed").otherwise("none"))


def shrink_slopes(fits: DataFrame, pooled: DataFrame, *, keys=("season", "metric"), floor_prior: bool = False) -> DataFrame:
    """Each slope drawn towards the pooled one by their precisions; without heterogeneity the pooled one itself."""
    tau = F.col("tau_squared")
    prior = F.greatest(tau, F.lit(FLOOR)) if floor_prior else tau
    p, own = F.try_divide(F.lit(1.0), prior), 1 / F.col("slope_variance")
    joined = fits.join(F.broadcast(pooled.select(*keys, "tau_squared", "pooled_mean", "pooled_variance")), list(keys))
    flat = tau <= 0
    star = F.when(flat, F.col("pooled_mean")).otherwise((F.col("slope") * own + F.col("pooled_mean") * p) / (own + p))
    var = F.when(flat, F.col("pooled_variance")).otherwise(F.greatest(F.lit(FLOOR), 1 / (own + p)))
    return joined.select(*fits.columns, star.alias("slope_star"), var.alias("slope_star_variance"))


def interval_margin(delta: Column, predictor_variance: Column, factor: Column | float = 1.0) -> Column:
    total = F.col("residual_variance") * (1 + 1 / F.col("n")) + F.col("slope_star_variance") * delta * delta + F.pow("slope_star", F.lit(2)) * predictor_variance
    return factor * Z80 * F.sqrt(F.greatest(F.lit(0.0), total))


def gmst_forecast(values: DataFrame, gmst: DataFrame, scenarios: DataFrame, groups: DataFrame, calibration: DataFrame) -> DataFrame:
    """Forecast per location, year, season and scenario from long values (location_id, year, season, metric, value)."""
    fits = gmst_fit(values, gmst)
    fits = shrink_slopes(fits, random_effects_pool(group_representatives(fits, groups)))
    order = Window.partitionBy("scenario").orderBy("year")
    same = F.lag("year").over(order) == F.col("year") - 1
    ahead = scenarios.withColumn("step", F.when(same, F.col("anomaly") - F.lag("anomaly").over(order)))
    # scenarios are a few hundred rows whatever the corpus
    rows = fits.join(F.broadcast(calibration), "metric").join(F.broadcast(ahead), F.col("year") > F.col("last_year"))
    delta = F.col("anomaly") - F.col("gbar")
    rows = rows.withColumns({"point": F.col("wbar") + F.col("slope_star") * delta, "margin": interval_margin(delta, F.pow("sigma_g", F.lit(2)), F.col("calibration_factor"))})
    second = F.col("metric").endswith("_avg")
    pick = lambda e, avg: F.max(F.when(second if avg else ~second, e))
    point, low, high = F.col("point"), F.col("point") - F.col("margin"), F.col("point") + F.col("margin")
    out = rows.groupBy("location_id", "year", "season", "scenario").agg(
        *(rounded(pick(e, avg), 1).alias(c + ("_avg" if avg else "")) for avg in (False, True) for c, e in (("wetbulb", point), ("lower", low), ("upper", high))),
        F.lit("gmst_linear").alias("model_type"),
        pick(F.col("n"), False).alias("full_years_used"),
        F.max("step").alias("warming_rate"),
    )
    return out.withColumn("acceleration", F.lit(0.0))


def gmst_forecast_tables(mean: DataFrame, max_: DataFrame, *, headline: str = "ssp245") -> dict[str, DataFrame]:
    return {
        "scenarios": mean,
        "max_scenarios": max_,
        "forecast": mean.where(F.col("scenario") == headline).drop("scenario"),
        "forecast_max": max_.where(F.col("scenario") == headline).drop("scenario"),
    }


def forecast_values(daily: DataFrame, *, statistic: str, as_of) -> DataFrame:
    return unpivot_metrics(yearly_qualified(daily, statistic=statistic), as_of=as_of, statistic=statistic)


def rebase_anomalies(raw: DataFrame, *, end_year: int, base: tuple[int, int] = (1850, 1900)) -> DataFrame:
    """Anomalies and bounds relative to the mean anomaly of the base years, up to ``end_year``."""
    kept = raw.where(F.col("year") <= end_year)
    mean = kept.where(F.col("year").between(*base)).agg(F.avg("anomaly").alias("base"))
    fields = [c for c in ("anomaly", "anomaly_lo", "anomaly_hi") if c in raw.columns]
    return kept.crossJoin(F.broadcast(mean)).select("year", *((F.col(c) - F.col("base")).alias(c) for c in fields))


def scenario_knots(spark, assessed=ASSESSED) -> DataFrame:
    rows = [(s, y, *map(float, v)) for s, by_year in assessed.items() for y, v in by_year.items()]
    return spark.createDataFrame(rows, "scenario string, year int, anomaly double, anomaly_lo double, anomaly_hi double")


def build_scenarios(obs: DataFrame, knots: DataFrame, *, end_year: int, horizon: int = 2100) -> DataFrame:
    """Piecewise-linear paths through the knots from the mean of the last 11 years, and the spread of years around their trend."""
    anchor = obs.where(F.col("year").between(end_year - 10, end_year)).agg(F.avg("anomaly").alias("a"))
    start = knots.select("scenario").distinct().crossJoin(F.broadcast(anchor)).select("scenario", F.lit(end_year - 5).alias("year"), *(F.col("a").alias(c) for c in ("anomaly", "anomaly_lo", "anomaly_hi")))
    points = start.unionByName(knots)
    order = Window.partitionBy("scenario").orderBy("year")
    fields = ("year", "anomaly", "anomaly_lo", "anomaly_hi")
    segments = points.select("scenario", *(F.col(c).alias(f"l_{c}") for c in fields), *(F.lead(c).over(order).alias(f"r_{c}") for c in fields), F.row_number().over(order).alias("i")).where("r_year is not null")
    segments = segments.withColumn("last", F.max("i").over(Window.partitionBy("scenario")))
    years = F.explode(F.sequence(F.when(F.col("i") == 1, F.lit(end_year + 1)).otherwise(F.col("l_year") + 1), F.when(F.col("i") == F.col("last"), F.lit(horizon)).otherwise(F.col("r_year"))))
    path = segments.withColumn("year", years)
    part = (F.col("year") - F.col("l_year")) / (F.col("r_year") - F.col("l_year"))
    near = Window.orderBy("year").rowsBetween(-2, 2)
    recent = obs.where(F.col("year").between(1990, end_year)).select("anomaly", F.when(F.count("anomaly").over(near) >= 3, F.avg("anomaly").over(near)).alias("trend"))  # one row a year
    sigma = recent.agg(F.stddev_samp(F.col("anomaly") - F.col("trend")).alias("sigma_g"))
    return path.crossJoin(F.broadcast(sigma)).select("scenario", "year", *((F.col(f"l_{c}") + part * (F.col(f"r_{c}") - F.col(f"l_{c}"))).alias(c) for c in fields[1:]), "sigma_g")
