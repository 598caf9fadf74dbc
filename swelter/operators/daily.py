"""Daily wet-bulb temperatures from hourly rows, and isolated spikes among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.functions.expr import KELVIN, half_even_tenths, saturation_hpa, shifted, specific_humidity, wetbulb_davies_jones, wetbulb_stull

SANE = (-50.0, 35.0)


def hourly_wetbulb(hourly: DataFrame, *, method: str = "davies_jones") -> DataFrame:
    """Rows with all three inputs, with ``tw``."""
    rows = hourly.where("Tair is not null and Qair is not null and PSurf is not null")
    t, q, p = (F.col(c).cast("double") for c in ("Tair", "Qair", "PSurf"))
    if method == "stull":
        e = q * p / 100 / (0.622 + 0.378 * q)
        return rows.withColumn("tw", wetbulb_stull(t - KELVIN, 100 * e / saturation_hpa(t - KELVIN)))
    return rows.withColumn("tw", wetbulb_davies_jones(t, q, p))


def daily_wetbulb(hourly: DataFrame, *, keys=("location_id",), min_daily_hours: int = 20, lo: float = SANE[0], hi: float = SANE[1], with_hours: bool = False, method: str = "davies_jones") -> DataFrame:
    """Highest and mean wet-bulb of each local day with enough distinct hours, rounded half-even to a tenth."""
    if min_daily_hours < 1:
        raise ValueError("min_daily_hours must be positive")
    rows = hourly_wetbulb(hourly, method=method).where(F.col("tw").between(lo, hi))
    local = shifted(F.col("time"), F.col("utc_offset_hours")) if "utc_offset_hours" in hourly.columns else F.col("time")
    rows = rows.select(*keys, local.cast("date").alias("date"), F.hour(local).alias("slot"), "tw")
    # a set of 24 bits keeps the distinct hours in the one aggregation
    hours = F.bit_count(F.bit_or(F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), F.col("slot")).cast("int")))
    out = rows.groupBy(*keys, "date").agg(F.max("tw").alias("m"), F.avg("tw").alias("a"), hours.cast("int").alias("observed_hours"))
    out = out.where(F.col("observed_hours") >= min_daily_hours)
    return out.select(*keys, "date", half_even_tenths("m").alias("wetbulb"), half_even_tenths("a").alias("wetbulb_avg"), *(["observed_hours"] if with_hours else []))


def location_hourly_from_station(hourly: DataFrame, station_map: DataFrame) -> DataFrame:
    """Station rows for every city that uses the station, in kelvin, kg/kg and pascal."""
    wanted = station_map.select("location_id", "station_id").distinct()
    rows = hourly.where("pressure_hpa is not null").join(wanted, "station_id")
    return rows.select("location_id", "station_id", "time", (F.col("tair_c") + KELVIN).alias("Tair"), specific_humidity(F.col("dewpoint_c"), F.col("pressure_hpa")).alias("Qair"), (F.col("pressure_hpa") * 100).alias("PSurf"))


def filter_daily_spikes(daily: DataFrame, *, keys=("location_id",), days: int = 3, min_neighbors: int = 2, jump: float = 8.0, mean_gap: float = 10.0, support: float = 3.0) -> DataFrame:
    """Without the days whose maximum stands alone above its neighbours and its own mean.

    Neighbours are the rows up to ``days`` before and after that lie within as many days; a null comparison keeps the row."""
    w = Window.partitionBy(*keys).orderBy("date")
    near, adjacent = [], []
    for k in range(1, days + 1):
        for f, sign in ((F.lag, 1), (F.lead, -1)):
            gap = F.datediff("date", f("date", k).over(w)) * sign
            value = F.when(gap <= days, f("wetbulb", k).over(w))
            near.append(value)
            if k == 1:
                adjacent.append(F.when(gap == 1, value))
    rows = daily.withColumns({"_near": F.array_sort(F.array_compact(F.array(*near))), "_beside": F.greatest(*adjacent)})
    n = F.size("_near")
    at = lambda i: F.try_element_at(F.col("_near"), i.cast("int"))
    median = (at(F.floor((n - 1) / 2) + 1) + at(F.floor(n / 2) + 1)) / 2
    alone = (n >= min_neighbors) & (F.col("wetbulb") - median >= jump) & (F.col("wetbulb") - F.col("wetbulb_avg") >= mean_gap) & ~F.coalesce(F.col("_beside") >= F.col("wetbulb") - support, F.lit(False))
    return rows.where(~F.coalesce(alone, F.lit(False))).drop("_near", "_beside")


def candidate_daily(hourly: DataFrame, station_map: DataFrame, *, source: str, min_daily_hours: int = 20, complete_hours: int = 20) -> DataFrame:
    """Daily rows per city and station with their provenance, within the years each map row stands for."""
    keys = ("location_id", "station_id")
    daily = daily_wetbulb(location_hourly_from_station(hourly, station_map), keys=keys, min_daily_hours=min_daily_hours, with_hours=True)
    daily = filter_daily_spikes(daily, keys=keys)
    have = lambda c, kind: F.col(c).cast(kind) if c in station_map.columns else F.lit(None).cast(kind)
    rows = station_map.select(
        *keys,
        have("reference_station_id", "string").alias("reference_station_id"),
        have("dist_km", "double").alias("station_distance_km"),
        have("elevation_difference_m", "double").alias("station_elevation_difference_m"),
        have("candidate_rank", "int").alias("candidate_rank"),
        have("variable_coverage", "double").alias("variable_coverage"),
        *(have(c, "int").alias(f"_{c}") for c in ("year", "start_year", "end_year")),
    )
    y = F.year("date")
    own = F.col("_year").isNotNull()
    inside = (own & (y == F.col("_year"))) | (~own & (F.coalesce(y >= F.col("_start_year"), F.lit(True))) & F.coalesce(y <= F.col("_end_year"), F.lit(True)))
    quality = F.when(F.col("observed_hours") >= complete_hours, "complete").otherwise("sparse")
    out = daily.join(rows, list(keys)).where(inside).drop("_year", "_start_year", "_end_year")
    return out.withColumns({"source": F.lit(source), "station_quality": quality})
