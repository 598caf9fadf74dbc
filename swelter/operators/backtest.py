"""Rolling-origin backtest of the climate-informed forecast against a plain trend."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swelter.functions.expr import days_in_season
from swelter.functions.session import durable
from swelter.operators.forecast import gmst_fit, group_representatives, interval_margin, random_effects_pool, shrink_slopes
from swelter.operators.stats import METRIC_COLUMNS, with_seasons

METRICS = ("avg_wetbulb", "max_wetbulb", "avg_wetbulb_avg", "max_wetbulb_avg")
OVERALL_LIMIT, METRIC_LIMIT, COVERAGE = 1.02, 1.05, (0.75, 0.85)
#: Of the sketches that bracket a quantile: ranks are right to one in so many.
ACCURACY = 10_000


def annual_metrics(daily: DataFrame) -> DataFrame:
    """Yearly and seasonal means and maxima; of several rows of a day, isd first, then the warmest, then by source."""
    first = Window.partitionBy("location_id", "date").orderBy((F.coalesce("source", F.lit("")) != "isd").cast("int"), F.desc("wetbulb"), F.desc("wetbulb_avg"), "source")
    one = daily.withColumn("r", F.row_number().over(first)).where("r = 1")
    stats = [e for c in METRIC_COLUMNS for e in (F.count(c).cast("int").alias("days_present" + c.removeprefix("wetbulb")), F.avg(c).alias(f"avg_{c}"), F.max(c).alias(f"max_{c}"))]
    out = with_seasons(one).groupBy("location_id", F.year("date").alias("year"), "season").agg(*stats)
    need = 0.95 * days_in_season(F.col("year"), F.col("season"))
    for tail in ("", "_avg"):
        enough = F.col(f"days_present{tail}") >= need
        out = out.withColumns({f"{s}_wetbulb{tail}": F.when(enough, F.col(f"{s}_wetbulb{tail}")) for s in ("avg", "max")})
    return out


def backtest_cases(annual: DataFrame, gmst: DataFrame, groups: DataFrame, *, origins=range(2009, 2025), first_year: int = 2000, horizon: int = 10, min_n: int = 10, oracle: bool = False) -> DataFrame:
    """Forecasts made at each origin from the years before it, beside what came and what a plain trend says.

    All origins run at once, as one more key of the fits: origins are joined to years by range.
    """
    spark = annual.sparkSession
    at = F.broadcast(spark.createDataFrame([(o,) for o in origins], "origin int"))
    # years before the first have no origin with a fit, and cities without a group no case; what is left is small beside the days, which
    # are gone through once for it
    annual = durable(annual.where(F.col("year") >= first_year).join(groups.select("location_id", "station_group"), "location_id").select("location_id", "station_group", "year", "season", *METRICS))
    long = annual.unpivot(["location_id", "station_group", "year", "season"], list(METRICS), "metric", "value").where("value is not null")
    train = long.join(at, F.col("year") <= F.col("origin"))
    keys = ("origin", "season", "metric")
    each = ["location_id", "station_group", *keys]
    trend = [F.avg("value").alias("vbar"), F.avg("year").alias("ybar"), F.regr_slope("value", "year").alias("per_year")]
    fits = gmst_fit(train, gmst, keys=each, min_n=min_n, more=trend)
    shrunk = shrink_slopes(fits, random_effects_pool(group_representatives(fits, groups, keys=keys), keys=keys), keys=keys, floor_prior=True)
    known = gmst.where(F.col("year") >= first_year).join(at, F.col("year") <= F.col("origin"))
    g = known.groupBy("origin").agg(F.count("*").alias("gn"), F.avg("year").alias("gy"), F.avg("anomaly").alias("ga"), F.regr_slope("anomaly", "year").alias("gs"), F.regr_sxx("anomaly", "year").alias("gx"), F.regr_syy("anomaly", "year").alias("gyy"))
    rest = F.greatest(F.lit(0.0), (F.col("gyy") - F.pow("gs", F.lit(2)) * F.col("gx")) / (F.col("gn") - 2))
    ahead = long.withColumnRenamed("value", "actual").join(at, (F.col("year") > F.col("origin")) & (F.col("year") <= F.col("origin") + horizon))
    rows = ahead.join(shrunk, each).where("per_year is not null")
    if oracle:
        rows = rows.join(F.broadcast(gmst.select("year", F.col("anomaly").alias("predictor"))), "year").withColumn("pvar", F.lit(0.0))
    else:
        gap = F.col("year") - F.col("gy")
        rows = rows.join(F.broadcast(g), "origin").withColumns({"predictor": F.col("ga") + F.col("gs") * gap, "pvar": rest * (1 + 1 / F.col("gn") + gap * gap / F.col("gx"))})
    delta = F.col("predictor") - F.col("gbar")
    rows = rows.withColumns({"gmst": F.col("wbar") + F.col("slope_star") * delta, "margin": interval_margin(delta, F.col("pvar")), "legacy": F.col("vbar") + F.col("per_year") * (F.col("year") - F.col("ybar"))})
    return rows.select("location_id", "station_group", "origin", "year", (F.col("year") - F.col("origin")).alias("horizon"), "metric", "season", "actual", "gmst", "legacy", (F.col("gmst") - F.col("margin")).alias("lower"), (F.col("gmst") + F.col("margin")).alias("upper"), F.lit(oracle).alias("oracle"))


def _standardised() -> Column:
    return F.abs(F.col("actual") - F.col("gmst")) / F.greatest((F.col("upper") - F.col("lower")) / 2, F.lit(sys.float_info.epsilon))


def brackets(rows: DataFrame, keys: list[str], value: str, q: float, accuracy: int = ACCURACY) -> DataFrame:
    """Per key the number of values and two of them, lo and hi, between which the ``q``-quantile lies.

    Both come from one mergeable sketch with a rank error of at most ``n / accuracy``, so at most ``5 n / accuracy`` values (and what
    equals lo or hi) lie between them."""
    at = [max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy)]
    found = rows.groupBy(*keys).agg(F.count(value).alias("n"), F.percentile_approx(value, at, accuracy).alias("_q"))
    return found.where("n > 0").select(*keys, "n", F.col("_q")[0].alias("lo"), F.col("_q")[1].alias("hi"))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, q: float, accuracy: int = ACCURACY) -> DataFrame:
    """(keys, value, n): the value of rank ceil(q (n - 1)) from 0 among those of each key, which is one of them.

    Values below a key's bracket are counted, those in it are added up by value before the shuffle, and only distinct values of the
    bracket are put in order, so neither outliers nor ties gather in one task. Should a sketch miss the rank, its key is done
    again with all values in the bracket. There must be few keys; nulls are passed over."""
    rows = rows.where(F.col(value).isNotNull())
    bounds = durable(brackets(rows, keys, value, q, accuracy))
    wanted = F.ceil(F.round(q * (F.col("n") - 1), 9)) + 1

    def chosen(bounds: DataFrame) -> DataFrame:
        near = rows.join(F.broadcast(bounds), keys).where(F.col(value) <= F.col("hi"))  # a row for each key
        counts = near.groupBy(*keys, "n", F.when(F.col(value) >= F.col("lo"), F.col(value)).alias(value)).agg(F.count("*").alias("_c"))
        upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first(value)))
        found = counts.withColumn("_u", upto).where((F.col("_u") >= wanted) & (F.col("_u") - F.col("_c") < wanted) & F.col(value).isNotNull())
        return found.select(*keys, value, "n")

    out = durable(chosen(bounds))
    missed = bounds.join(out, keys, "left_anti")
    if missed.take(1):
        out = out.unionByName(chosen(missed.withColumns({"lo": F.lit(float("-inf")), "hi": F.lit(float("inf"))})))
    return out


def calibration_factors(cases: DataFrame, origins: DataFrame | int, *, q: float = 0.7, min_cases: int = 100) -> DataFrame:
    """Interval factors per origin and metric from the errors known by then, one case a group; at least 1."""
    at = cases.sparkSession.createDataFrame([(origins,)], "gate int") if isinstance(origins, int) else origins.select(F.col("origin").alias("gate"))
    # which case stands for a group does not depend on the gate, so one of each is left before they meet the gates
    one = cases.where("season = 'Annual'").groupBy("station_group", "origin", "year", "metric").agg(F.min_by(_standardised(), "location_id").alias("score"))
    scores = one.join(F.broadcast(at), (F.col("origin") < F.col("gate")) & (F.col("year") <= F.col("gate"))).select("gate", "metric", "score")
    # the q-quantile without interpolation, rounded up: rank ceil(q (n - 1)) from 0
    picked = exact_quantiles(durable(scores), ["gate", "metric"], "score", q)
    factor = F.when(F.col("n") >= min_cases, F.greatest("score", F.lit(1.0))).otherwise(1.0)
    grid = at.crossJoin(cases.sparkSession.createDataFrame([(m,) for m in METRICS], "metric string"))
    return grid.join(picked.withColumn("f", factor), ["gate", "metric"], "left").select(F.col("gate").alias("origin"), "metric", F.coalesce("f", F.lit(1.0)).alias("factor"))


def calibrate_intervals(cases: DataFrame, *, gate_origins=range(2012, 2025)) -> DataFrame:
    """Cases of the gate origins with margins scaled by what was known at each."""
    at = cases.sparkSession.createDataFrame([(o,) for o in gate_origins], "origin int")
    factors = calibration_factors(cases, at)
    half = (F.col("upper") - F.col("lower")) / 2
    out = cases.join(F.broadcast(factors), ["origin", "metric"]).withColumnRenamed("factor", "calibration_factor").withColumn("raw_margin", half)
    wide = F.col("raw_margin") * F.col("calibration_factor")
    return out.withColumns({"lower": F.col("gmst") - wide, "upper": F.col("gmst") + wide})


def _errors(cases: DataFrame) -> DataFrame:
    e = {f"{m}_{k}": f for m in ("gmst", "legacy") for k, f in (("abs", F.abs(F.col(m) - F.col("actual"))), ("sq", F.pow(F.col(m) - F.col("actual"), 2)))}
    return cases.where("horizon between 5 and 10").withColumns(e | {"covered": F.col("actual").between(F.col("lower"), F.col("upper")).cast("double")})


def _ratios() -> list[Column]:
    return [
        F.try_divide(F.avg("gmst_abs"), F.avg("legacy_abs")).alias("mae_ratio"),
        F.sqrt(F.try_divide(F.avg("gmst_sq"), F.avg("legacy_sq"))).alias("rmse_ratio"),
        F.avg("covered").alias("coverage_80"),
    ]


def evaluate_gate(cases: DataFrame) -> DataFrame:
    """Annual cases of horizons 5 to 10: ratios overall (metric null) and per metric, and whether the gate passes."""
    rows = _errors(cases).where("season = 'Annual'").rollup("metric").agg(*_ratios(), F.min("calibration_factor").alias("factor_min"), F.max("calibration_factor").alias("factor_max"), F.count("*").alias("n"))
    overall = F.col("metric").isNull()
    within = (F.col("mae_ratio") <= F.when(overall, OVERALL_LIMIT).otherwise(METRIC_LIMIT)) & (F.col("rmse_ratio") <= F.when(overall, OVERALL_LIMIT).otherwise(METRIC_LIMIT)) & (overall | F.col("coverage_80").between(*COVERAGE))
    return rows.withColumn("passed", F.min(within).over(Window.partitionBy(F.lit(1))))  # five rows


def seasonal_diagnostics(cases: DataFrame) -> DataFrame:
    return _errors(cases).groupBy("season", "metric").agg(*_ratios(), F.count("*").alias("n"))


def bootstrap_ratios(cases: DataFrame, *, samples: int = 1000, seed: int = 0) -> DataFrame:
    """95 % intervals of the ratios over resampled station groups, per metric and overall (metric null).

    Draw ``d`` of a replicate takes the group whose number is the first 32 bits of the digest of seed, replicate, metric and ``d``,
    modulo the number of groups, so a resample does not depend on how rows are dealt."""
    sums = [F.sum(c).alias(c) for c in ("gmst_abs", "legacy_abs", "gmst_sq", "legacy_sq")]
    per = _errors(cases).where("season = 'Annual'").groupBy("metric", "station_group").agg(*sums)
    per = per.unionByName(per.groupBy("station_group").agg(*sums).withColumn("metric", F.lit(None).cast("string")))
    per = per.withColumn("m", F.coalesce("metric", F.lit(""))).withColumns({"i": F.row_number().over(Window.partitionBy("m").orderBy("station_group")) - 1, "g": F.count("*").over(Window.partitionBy("m"))})
    sizes = per.select("m", "g").distinct()
    draws = cases.sparkSession.range(samples).withColumnRenamed("id", "replicate").crossJoin(F.broadcast(sizes)).select("replicate", "m", "g", F.explode(F.sequence(F.lit(1), F.col("g"))).alias("d"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("replicate").cast("string"), "m", F.col("d").cast("string")))
    pick = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("g")).alias("i")
    drawn = draws.select("replicate", "m", pick).join(per.drop("g"), ["m", "i"])
    each = drawn.groupBy("m", "replicate").agg(F.try_divide(F.sum("gmst_abs"), F.sum("legacy_abs")).alias("mae"), F.sqrt(F.try_divide(F.sum("gmst_sq"), F.sum("legacy_sq"))).alias("rmse"))
    out = each.groupBy("m").agg(*(F.expr(f"percentile({c}, {p})").alias(f"{c}_ratio_{n}") for c in ("mae", "rmse") for p, n in ((0.025, "low"), (0.975, "high"))))
    return out.select(F.when(F.col("m") != "", F.col("m")).alias("metric"), *out.columns[1:])
