"""Seasonal statistics, qualified years and city rankings."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.functions.expr import days_in_season, rounded, season

METRIC_COLUMNS = ("wetbulb", "wetbulb_avg")
REGIONS = {"na": (0, 999), "eu": (1000, None)}


def with_seasons(daily: DataFrame) -> DataFrame:
    """Each day twice: in the Annual season and in that of its month (winter is January, February and December of one year)."""
    return daily.withColumn("season", F.explode(F.array(F.lit("Annual"), season(F.col("date")))))


def year_stats(daily: DataFrame) -> DataFrame:
    """Mean, maximum and exact interpolated percentiles per location, year and season, to a tenth; no coverage gate."""
    # days are dealt out by location once, and doubled into their two seasons only after that exchange
    rows = with_seasons(daily.select("location_id", "date", *METRIC_COLUMNS).repartition("location_id")).withColumn("year", F.year("date"))
    out = []
    for c in METRIC_COLUMNS:
        tail = c.removeprefix("wetbulb")
        out += [rounded(F.avg(c), 1).alias(f"avg_{c}"), rounded(F.max(c), 1).alias(f"max_{c}")]
        out.append(F.expr(f"percentile({c}, array(0.05, 0.1, 0.9, 0.95))").alias(f"q{tail}"))
    grouped = rows.groupBy("location_id", "year", "season").agg(*out)
    for tail in ("", "_avg"):
        grouped = grouped.withColumns({f"{p}{tail}": rounded(F.col(f"q{tail}")[k], 1) for k, p in enumerate(("p5", "p10", "p90", "p95"))}).drop(f"q{tail}")
    return grouped


def yearly_qualified(daily: DataFrame, *, statistic: str = "mean", coverage: float = 0.95) -> DataFrame:
    """Yearly mean or maximum of daily maxima with day counts; a metric is null below ``coverage`` of the season's days."""
    # one exchange, by location: days, seasons and years of a location are then at hand in one task
    per_day = daily.select("location_id", "date", *METRIC_COLUMNS).repartition("location_id").groupBy("location_id", "date").agg(*(F.max(c).alias(c) for c in METRIC_COLUMNS))
    parts = per_day.groupBy("location_id", F.year("date").alias("year"), season(F.col("date")).alias("season")).agg(
        *(f(c).alias(f"{n}_{c}") for c in METRIC_COLUMNS for n, f in (("sum", F.sum), ("max", F.max), ("n", F.count)))
    )
    # the year is rolled up from its four seasons, not from its days
    both = parts.withColumn("season", F.explode(F.array(F.lit("Annual"), "season"))).groupBy("location_id", "year", "season")
    years = both.agg(*(f(f"{n}_{c}").alias(f"{n}_{c}") for c in METRIC_COLUMNS for n, f in (("sum", F.sum), ("max", F.max), ("n", F.sum))))
    value = lambda c: F.col(f"max_{c}") if statistic == "max" else F.try_divide(f"sum_{c}", f"n_{c}")
    years = years.select("location_id", "year", "season", value("wetbulb").alias("p"), value("wetbulb_avg").alias("a"), F.col("n_wetbulb").cast("int").alias("days_present"), F.col("n_wetbulb_avg").cast("int").alias("days_present_avg"))
    need = (coverage * days_in_season(F.col("year"), F.col("season"))).alias("required_days")
    years = years.withColumn("required_days", need)
    return years.select(
        "location_id",
        "year",
        "season",
        F.when(F.col("days_present") >= F.col("required_days"), F.col("p")).alias("primary_value"),
        F.when(F.col("days_present_avg") >= F.col("required_days"), F.col("a")).alias("average_value"),
        "days_present",
        "days_present_avg",
        "required_days",
    )


def unpivot_metrics(qualified: DataFrame, *, as_of: datetime.date, first_year: int = 1990, statistic: str = "mean") -> DataFrame:
    """One row per location, year, season and metric that has a value, up to the last full year."""
    head = "max_wetbulb" if statistic == "max" else "avg_wetbulb"
    named = qualified.select("location_id", "year", "season", F.col("primary_value").alias(head), F.col("average_value").alias(f"{head}_avg"))
    long = named.unpivot(["location_id", "year", "season"], [head, f"{head}_avg"], "metric", "value")
    return long.where(F.col("year").between(first_year, as_of.year - 1) & F.col("value").isNotNull())


def _ranked(stats: DataFrame, locations: DataFrame, forecast: DataFrame, base: DataFrame, region: str) -> DataFrame:
    low, high = REGIONS[region]
    stats = stats.where(F.col("location_id") >= low) if high is None else stats.where(F.col("location_id").between(low, high))
    ends = ("lower", "upper", "lower_avg", "upper_avg")
    future = forecast.where("year = 2100").select("location_id", "season", *(F.col(c).alias(f"future_{c}") for c in ends))
    out = stats.join(locations.select(F.col("id").alias("location_id"), "city", "state"), "location_id")
    out = out.join(future, ["location_id", "season"], "left").join(base, ["location_id", "season"], "left")
    change = lambda c: F.round((F.col(c) - F.col(f"base_{c}")).cast("decimal(20,6)"), 2).cast("double")
    return out.select(
        "location_id",
        "year",
        "season",
        *(f"{s}_{c}" for c in METRIC_COLUMNS for s in ("avg", "max")),
        "city",
        "state",
        *(f"{p}{t}" for p in ("p5", "p10", "p90", "p95") for t in ("", "_avg")),
        *(f"future_{c}" for c in ends),
        change("avg_wetbulb").alias("change_from_1990"),
        change("avg_wetbulb_avg").alias("change_from_1990_avg"),
    )


def city_rankings(stats: DataFrame, locations: DataFrame, forecast: DataFrame, *, region: str = "na") -> DataFrame:
    """Year statistics of a region with place names, the forecast of 2100, and the change since 1990."""
    base = stats.where("year = 1990").select("location_id", "season", *(F.col(f"avg_{c}").alias(f"base_avg_{c}") for c in METRIC_COLUMNS))
    return _ranked(stats, locations, forecast, base, region)


def city_rankings_blended(stats: DataFrame, locations: DataFrame, forecast: DataFrame) -> DataFrame:
    """The older variant: the 1990 value may come from the forecast where it was not observed."""
    base = None
    for c in METRIC_COLUMNS:
        seen = stats.where("year = 1990").select("location_id", "season", F.col(f"avg_{c}").alias("v"), F.lit(0).alias("o"))
        told = forecast.where("year = 1990").select("location_id", "season", F.col(c).alias("v"), F.lit(1).alias("o"))
        both = seen.unionByName(told if c == "wetbulb" else told.where("v is not null"))
        first = F.row_number().over(Window.partitionBy("location_id", "season").orderBy("o"))
        one = both.withColumn("r", first).where("r = 1").select("location_id", "season", F.col("v").alias(f"base_avg_{c}"))
        base = one if base is None else base.join(one, ["location_id", "season"], "full")
    return _ranked(stats, locations, forecast, base, "na")
