"""Missing city-days and their filling from gridded hours."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.operators.daily import daily_wetbulb

FILL_SOURCES = ("nldas", "era5land", "giovanni")


#: Days of a year as bits of so many 64-bit words.
WORDS = 6


def gap_years(locations: DataFrame, daily: DataFrame, *, start: datetime.date, end: datetime.date, as_of: datetime.date, lag_days: int = 5, include_fill: bool = False) -> DataFrame:
    """(location_id, year, first, days, words, n_missing) for each location and year of the calendar that lacks days: the first day, the
    number of days, and those that are there with both metrics as bits, from New Year's Day on.

    Days are added up as bits, so what is shuffled is a few words per location and year. The calendar ends ``lag_days`` before ``as_of``.
    Rows of the same id in ``locations`` give rows each; a null id has no days."""
    last = min(end, as_of - datetime.timedelta(days=lag_days))
    have = daily.where("wetbulb is not null and wetbulb_avg is not null").where(F.col("date").between(F.lit(start), F.lit(last)))
    if not include_fill and "source" in daily.columns:
        have = have.where(~F.coalesce(F.col("source").isin(*FILL_SOURCES), F.lit(False)))
    days = have.select("location_id", F.year("date").alias("year"), (F.dayofyear("date") - 1).alias("_n"))
    word, bit = F.shiftright("_n", 6), F.expr("shiftleft(1L, _n % 64)")
    seen = days.groupBy("location_id", "year").agg(*(F.bit_or(F.when(word == k, bit)).alias(f"_w{k}") for k in range(WORDS)))
    years = F.explode(F.sequence(F.lit(start.year), F.lit(last.year))) if start <= last else F.explode(F.array().cast("array<int>"))
    wanted = locations.select(F.col("id").alias("location_id"), years.alias("year"))
    words = [F.coalesce(f"_w{k}", F.lit(0).cast("long")) for k in range(WORDS)]
    first = F.greatest(F.make_date("year", F.lit(1), F.lit(1)), F.lit(start))
    total = F.date_diff(F.least(F.make_date("year", F.lit(12), F.lit(31)), F.lit(last)), first) + 1
    there = reduce(add, (F.bit_count(w) for w in words))
    both = wanted.join(seen, ["location_id", "year"], "left")
    return both.select("location_id", "year", first.alias("first"), total.alias("days"), F.array(*words).alias("words"), (total - there).alias("n_missing")).where("n_missing > 0")


def absent_dates(years: DataFrame) -> DataFrame:
    """(location_id, date) of the days that are missing in rows of :func:`gap_years`."""
    each = years.select("location_id", "first", "words", (F.dayofyear("first") - 1).alias("_from"), F.explode(F.sequence(F.lit(0), F.col("days") - 1)).alias("_k"))
    free = F.expr("(shiftright(words[int(shiftright(_from + _k, 6))], (_from + _k) % 64) & 1) = 0")
    return each.where(free).select("location_id", F.date_add("first", F.col("_k")).alias("date"))


def missing_cells(locations: DataFrame, daily: DataFrame, *, start: datetime.date, end: datetime.date, as_of: datetime.date, lag_days: int = 5, include_fill: bool = False) -> DataFrame:
    """City-days of the calendar without a row that has both metrics; the calendar ends ``lag_days`` before ``as_of``."""
    years = gap_years(locations, daily, start=start, end=end, as_of=as_of, lag_days=lag_days, include_fill=include_fill)
    # few bytes become many rows, so the rows are dealt to all tasks, which partitions sized by bytes would not do
    return absent_dates(years.repartition(int(locations.sparkSession.conf.get("spark.sql.shuffle.partitions")), "location_id", "year"))


def material_gaps(missing: DataFrame, *, min_missing_days: int = 19) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("location_id", F.year("date")))
    return missing.withColumn("_n", n).where(F.col("_n") >= min_missing_days).drop("_n")


def gap_year_ranges(missing: DataFrame) -> DataFrame:
    """Runs of consecutive years with gaps, per city."""
    years = missing.select("location_id", F.year("date").alias("y")).distinct()
    run = F.col("y") - F.row_number().over(Window.partitionBy("location_id").orderBy("y"))
    return years.withColumn("run", run).groupBy("location_id", "run").agg(F.min("y").alias("start_year"), F.max("y").alias("end_year")).drop("run")


def fill_gaps(hourly: DataFrame, missing: DataFrame, *, source: str, min_daily_hours: int = 20, incomplete: DataFrame | None = None) -> DataFrame:
    """Daily values of the missing cells; an error if any of the wanted cities was fetched incompletely."""
    if incomplete is not None:
        bad = incomplete.join(missing.select("location_id").distinct(), "location_id", "left_semi").limit(5).collect()
        if bad:
            raise ValueError(f"hourly rows are incomplete for locations {sorted(r['location_id'] for r in bad)}")
    return daily_wetbulb(hourly, min_daily_hours=min_daily_hours).join(missing, ["location_id", "date"], "left_semi").withColumn("source", F.lit(source))


def recovered_spans(ranges: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The gap ranges with ``recovered``: whether one span of the snapshot (location_id, start_year, end_year) contains the range.

    A range is there whole or not at all: neither a span that ends inside it nor two spans beside one another count. Ranges and spans
    are swept together in the order of their first year, so no pairs are made: a range is contained if a span that began by then
    reaches its end. Of the spans that begin in one year only the longest is shuffled."""
    spans = snapshot.groupBy("location_id", "start_year").agg(F.max("end_year").alias("_reach"))
    both = ranges.withColumn("_reach", F.lit(None).cast("int")).unionByName(spans, allowMissingColumns=True)
    order = Window.partitionBy("location_id").orderBy("start_year").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max("_reach").over(order)
    return both.withColumn("recovered", F.coalesce(reach >= F.col("end_year"), F.lit(False))).where("end_year is not null").drop("_reach")


def span_recovery_report(ranges: DataFrame, snapshot: DataFrame, *, allow_partial: bool = False) -> DataFrame:
    """Per city, how many of its gap ranges a snapshot of fetched spans has whole: location_id, expected, recovered, complete.

    Unless partial recovery is allowed, a city with a range that is not there is an error."""
    out = recovered_spans(ranges, snapshot).groupBy("location_id").agg(F.count("*").alias("expected"), F.count_if("recovered").alias("recovered"))
    out = out.withColumn("complete", F.col("expected") == F.col("recovered"))
    if not allow_partial:
        lost = [r["location_id"] for r in out.where("not complete").orderBy("location_id").limit(6).collect()]
        if lost:
            raise ValueError(f"the snapshot lacks spans of locations {lost[:5]}{' and others' if len(lost) > 5 else ''}")
    return out


def recovered_cells(missing: DataFrame, snapshot: DataFrame, *, allow_partial: bool = False) -> DataFrame:
    """The missing city-days that a snapshot can fill: those in gap ranges that it has whole. Without ``allow_partial``, all or an error."""
    ranges = gap_year_ranges(missing)
    if not allow_partial:
        span_recovery_report(ranges, snapshot)
    there = recovered_spans(ranges, snapshot).where("recovered").select("location_id", F.explode(F.sequence("start_year", "end_year")).alias("_y"))
    return missing.withColumn("_y", F.year("date")).join(there, ["location_id", "_y"], "left_semi").select(*missing.columns)
