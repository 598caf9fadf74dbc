"""Choice of stations and one baseline for all stations of a city."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.operators.daily import SANE


def station_map_for_years(station_map: DataFrame, years, *, excluded=()) -> DataFrame:
    """Map rows whose own year, or else span of years, can serve the wanted years; a null bound is open."""
    years = sorted(set(years))
    out = station_map.where(~F.col("station_id").isin(*excluded)) if excluded else station_map
    if "year" in out.columns:
        out = out.where(F.col("year").isNull() | F.col("year").isin(*years))
    else:
        for c, test in (("start_year", F.col("start_year") <= years[-1] if "start_year" in out.columns else None), ("end_year", F.col("end_year") >= years[0] if "end_year" in out.columns else None)):
            if test is not None:
                out = out.where(F.col(c).isNull() | test)
    if "candidate_rank" not in out.columns:
        out = out.withColumn("candidate_rank", F.row_number().over(Window.partitionBy("location_id").orderBy("station_id")))
    return out


def assign_reference_stations(station_map: DataFrame, *, lookback_years: int = 10) -> DataFrame:
    """One stable reference station per city: most often first in the last years, then best covered, then nearest."""
    ranked = station_map.withColumn("candidate_rank", F.coalesce(F.col("candidate_rank"), F.lit(999)))
    recent = ranked
    if "year" in ranked.columns:
        latest = ranked.agg(F.max("year").alias("_latest"))
        recent = ranked.crossJoin(F.broadcast(latest)).where(F.col("_latest").isNull() | (F.col("year") >= F.col("_latest") - lookback_years + 1))
    scores = recent.groupBy("location_id", "station_id").agg(
        F.sum((F.col("candidate_rank") == 1).cast("int")).alias("first"), F.count("*").alias("rows"), F.avg("variable_coverage").alias("coverage"), F.median("dist_km").alias("km"), F.median("elevation_difference_m").alias("elev")
    )
    best = Window.partitionBy("location_id").orderBy(F.desc("first"), F.desc("rows"), F.desc_nulls_last("coverage"), F.asc_nulls_last("km"), F.asc_nulls_last("elev"), "station_id")
    reference = scores.withColumn("r", F.row_number().over(best)).where("r = 1").select("location_id", F.col("station_id").alias("reference_station_id"))
    return ranked.join(reference, "location_id", "left")


def homogenize_stations(candidates: DataFrame, *, min_month_days: int = 20, min_global_days: int = 60, max_adjustment: float = 5.0, lo: float = SANE[0], hi: float = SANE[1]) -> DataFrame:
    """Secondary stations moved onto the baseline of the reference by median differences of the days both have.

    A month with enough common days has its own adjustment, else the overall one serves if there are enough days at all; a station
    with any adjustment beyond ``max_adjustment`` goes whole, a moved value out of range goes alone."""
    is_reference = F.col("station_id") == F.col("reference_station_id")
    reference = candidates.where(is_reference)
    base = reference.select("location_id", "date", F.col("wetbulb").alias("_rw"), F.col("wetbulb_avg").alias("_ra"))
    keys = ["location_id", "station_id"]
    secondary = candidates.where(~is_reference).withColumn("_month", F.month("date"))
    paired = secondary.join(base, ["location_id", "date"]).select(*keys, "_month", (F.col("_rw") - F.col("wetbulb")).alias("dw"), (F.col("_ra") - F.col("wetbulb_avg")).alias("da"))
    found = lambda *by: paired.groupBy(*by).agg(F.count("*").alias("n"), F.median("dw").alias("w"), F.median("da").alias("a"))
    monthly = found(*keys, "_month").select(*keys, "_month", *(F.col(c).alias(f"m{c}") for c in "nwa"))
    overall = found(*keys).select(*keys, *(F.col(c).alias(f"g{c}") for c in "nwa"))
    rows = secondary.join(overall, keys).join(monthly, [*keys, "_month"], "left")
    by_month = F.coalesce(F.col("mn") >= min_month_days, F.lit(False))
    rows = rows.where(by_month | (F.col("gn") >= min_global_days)).withColumns(
        {
            "homogenization_method": F.when(by_month, "monthly_overlap").otherwise("global_overlap"),
            "homogenization_overlap_days": F.when(by_month, F.col("mn")).otherwise(F.col("gn")).cast("int"),
            "wetbulb_adjustment": F.when(by_month, F.col("mw")).otherwise(F.col("gw")),
            "wetbulb_avg_adjustment": F.when(by_month, F.col("ma")).otherwise(F.col("ga")),
        }
    )
    largest = F.max(F.greatest(F.abs("wetbulb_adjustment"), F.abs("wetbulb_avg_adjustment"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("_largest", largest).where(F.coalesce(F.col("_largest") <= max_adjustment, F.lit(True)))
    rows = rows.withColumns({c: F.col(c) + F.col(f"{c}_adjustment") for c in ("wetbulb", "wetbulb_avg")}).where(F.col("wetbulb").between(lo, hi) & F.col("wetbulb_avg").between(lo, hi))
    own = {"homogenization_method": F.lit("reference"), "homogenization_overlap_days": F.lit(0), "wetbulb_adjustment": F.lit(0.0), "wetbulb_avg_adjustment": F.lit(0.0)}
    return reference.withColumns(own).unionByName(rows.select(*candidates.columns, *own))


def select_best_station_days(candidates: DataFrame) -> DataFrame:
    """One row per city and day, never mixed: the reference, then most hours, best coverage, nearest, smallest id."""
    same = F.coalesce(F.col("station_id") == F.col("reference_station_id"), F.lit(False)) if "reference_station_id" in candidates.columns else F.lit(False)
    best = Window.partitionBy("location_id", "date").orderBy(F.desc(same), F.desc_nulls_last("observed_hours"), F.desc(F.coalesce("variable_coverage", F.lit(0.0))), F.asc_nulls_last("station_distance_km"), "station_id")
    return candidates.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r", "candidate_rank", "variable_coverage")
