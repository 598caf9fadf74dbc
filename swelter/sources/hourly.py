"""Archive rows to the canonical hourly frames.

Station archives become (station_id, time, tair_c, dewpoint_c, pressure_hpa) in local standard time; gridded ones become
(location_id, time, Tair, Qair, PSurf). Every text field is read with ``try_cast``, so what does not parse is missing.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swelter.functions.expr import KELVIN, shifted, specific_humidity, station_pressure

# Fixed values of the archives: report types in order of preference, rejected quality codes, physical bounds, missing marks.
GHCNH_REPORTS = ("FM15", "FM16", "SAO", "SAOSP", "SSA", "SAAU", "SYMT", "SYSA", "SYAU", "SYAE", "FM12", "FM94_1", "AUTO", "MESOH", "MESOS", "AUST", "BRAZ", "GREEN", "MEXIC", "SMARS", "WBO", "WNO", "EnvCan")
SURFACE_REPORTS = ("FM-15", "FM-16", "FM-12")
REJECTED = ("2", "3", "6", "7")
TEMPERATURE, DEWPOINT, DEWPOINT_EXCESS = (-80.0, 60.0), (-100.0, 40.0), 1.0
FILL = -9000.0


def number(c: Column | str) -> Column:
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def instant(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def _have(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _priority(report: Column, order) -> Column:
    return F.array_position(F.lit(list(order)), report)


def _station_rows(rows: DataFrame, offsets: DataFrame | None, as_of: datetime.datetime | None) -> DataFrame:
    """One row per station and time by report priority, with derived pressure, in local time. Reports of one kind and time go by their
    values down to the last column, so the row kept does not depend on how rows are dealt."""
    values = ("tair_c", "dewpoint_c", "station", "sea", "altimeter", "elevation", "lon")
    best = Window.partitionBy("station_id", "t").orderBy("priority", *(F.desc_nulls_last(c) for c in values))
    rows = rows.where("t is not null and tair_c is not null and dewpoint_c is not null").withColumn("_r", F.row_number().over(best)).where("_r = 1")
    rows = rows.withColumn("pressure_hpa", station_pressure(*(F.col(c) for c in ("station", "sea", "altimeter", "elevation", "tair_c"))))
    if offsets is not None:
        rows = rows.join(offsets.select("station_id", F.col("utc_offset_hours").cast("double").alias("_u")), "station_id", "left")
    hours = F.coalesce(*([F.col("_u")] if offsets is not None else []), F.rint(F.coalesce("lon", F.lit(0.0)) / 15))
    rows = rows.withColumns({"hours": hours, "time": shifted(F.col("t"), hours)})
    if as_of is not None:
        today = shifted(F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"), F.col("hours")).cast("date")
        rows = rows.where(F.col("time").cast("date") < today)
    return rows.where("pressure_hpa is not null").select("station_id", "time", "tair_c", "dewpoint_c", "pressure_hpa")


def hourly_ghcnh(raw: DataFrame, *, offsets: DataFrame | None = None, as_of: datetime.datetime | None = None) -> DataFrame:
    """Station-years of the hourly parquet archive; with ``as_of``, the local day of that moment and later are left out."""

    def good(c: str) -> Column:
        bad = F.trim(F.col(f"{c}_Quality_Code").cast("string")).isin(*REJECTED)
        return F.when(~F.coalesce(bad, F.lit(False)), number(F.col(c)))

    report = F.trim(F.col("temperature_Report_Type"))
    rows = raw.where(report.isin(*GHCNH_REPORTS)).select(
        "station_id", instant(F.col("DATE")).alias("t"), number(F.col("ELEVATION")).alias("elevation"), number(_have(raw, "LONGITUDE")).alias("lon"), _priority(report, GHCNH_REPORTS).alias("priority"),
        good("temperature").alias("tair_c"), good("dew_point_temperature").alias("dewpoint_c"), good("station_level_pressure").alias("station"), good("sea_level_pressure").alias("sea"), good("altimeter").alias("altimeter"),
    )
    rows = rows.where(F.col("tair_c").between(*TEMPERATURE) & F.col("dewpoint_c").between(*DEWPOINT) & (F.col("dewpoint_c") <= F.col("tair_c") + DEWPOINT_EXCESS))
    return _station_rows(rows, offsets, as_of)


def _packed(field: Column, missing: float, at: int = 0) -> Column:
    """A tenth of the value of a packed "value,code" field; the missing mark is compared as a number, whatever its sign."""
    parts = F.split(field, ",")
    value = number(F.get(parts, at))
    return F.when((F.abs(value) != missing) & ~F.coalesce(F.get(parts, at + 1).isin(*REJECTED), F.lit(False)), value / 10)


def hourly_isd(raw: DataFrame, candidates: DataFrame | None = None, *, offsets: DataFrame | None = None) -> DataFrame:
    """Packed CSV station-years (all strings, some columns may be absent). ``candidates`` (location_id, position, station_id) keeps,
    per location and year, the first id that has hourly rows."""
    report = F.trim(_have(raw, "REPORT_TYPE"))
    rows = raw.where(report.isin(*SURFACE_REPORTS)).select(
        F.col("STATION").alias("station_id"), instant(F.col("DATE")).alias("t"), number(_have(raw, "ELEVATION")).alias("elevation"), number(_have(raw, "LONGITUDE")).alias("lon"), _priority(report, SURFACE_REPORTS).alias("priority"),
        _packed(_have(raw, "TMP"), 9999).alias("tair_c"), _packed(_have(raw, "DEW"), 9999).alias("dewpoint_c"), _packed(_have(raw, "MA1"), 99999, 2).alias("station"), _packed(_have(raw, "SLP"), 99999).alias("sea"), _packed(_have(raw, "MA1"), 99999).alias("altimeter"),
    )
    out = _station_rows(rows, offsets, None)
    if candidates is None:
        return out
    years = out.select("station_id", F.year("time").alias("year")).distinct().join(candidates, "station_id")
    first = F.row_number().over(Window.partitionBy("location_id", "year").orderBy("position"))
    chosen = years.withColumn("_r", first).where("_r = 1").select("station_id", "year").distinct()
    return out.withColumn("year", F.year("time")).join(chosen, ["station_id", "year"], "left_semi").drop("year")


def hourly_lcd(raw: DataFrame) -> DataFrame:
    """Local climatological CSV: plain columns, local times."""
    report = F.trim(F.col("REPORT_TYPE"))
    n = lambda c: number(F.col(c))
    rows = raw.where(report.isin(*SURFACE_REPORTS)).select(
        "station_id", instant(F.col("DATE")).alias("t"), n("ELEVATION").alias("elevation"), F.lit(0.0).alias("lon"), _priority(report, SURFACE_REPORTS).alias("priority"), n("HourlyDryBulbTemperature").alias("tair_c"),
        n("HourlyDewPointTemperature").alias("dewpoint_c"), n("HourlyStationPressure").alias("station"), n("HourlySeaLevelPressure").alias("sea"), n("HourlyAltimeterSetting").alias("altimeter"),
    )
    return _station_rows(rows, None, None)


def hourly_eccc(pages: DataFrame, *, offsets: DataFrame, as_of: datetime.datetime | None = None) -> DataFrame:
    """GeoJSON pages: features[].properties with flags. A flag that is not blank nulls its value; kPa become hPa."""
    p = pages.select(F.explode("features").alias("f")).select("f.properties.*")

    def value(c: str) -> Column:
        flag = F.trim(_have(p, f"{c}_FLAG"))
        return F.when(flag.isNull() | (flag == ""), number(F.col(c).cast("string")))

    rows = p.select(F.col("STN_ID").cast("string").alias("station_id"), instant(F.col("UTC_DATE")).alias("t"), value("TEMP").alias("tair_c"), value("DEW_POINT_TEMP").alias("dewpoint_c"), (value("STATION_PRESSURE") * 10).alias("pressure_hpa"))
    rows = rows.join(offsets.select("station_id", F.col("utc_offset_hours").cast("double").alias("h")), "station_id").withColumn("time", shifted(F.col("t"), F.col("h")))
    if as_of is not None:
        today = shifted(F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"), F.col("h")).cast("date")
        rows = rows.where((F.year("t") != as_of.year) | (F.col("time").cast("date") < today))
    columns = ["station_id", "time", "tair_c", "dewpoint_c", "pressure_hpa"]
    return rows.select(*columns).dropna().groupBy("station_id", "time").agg(F.min(F.struct(*columns[2:])).alias("v")).select("station_id", "time", "v.*")


def parse_point_series(files: DataFrame) -> DataFrame:
    """location_id, var, time, value from whole files (location_id, value): a "key,value" head, then "time,value" rows."""
    lines = files.select("location_id", F.regexp_extract("value", r"param_short_name,([^\r\n]*)", 1).alias("var"), F.explode(F.split("value", r"\r?\n")).alias("line"))
    parts = F.split("line", ",")
    rows = lines.select("location_id", F.trim("var").alias("var"), instant(F.trim(parts[0])).alias("time"), number(F.trim(F.get(parts, 1))).alias("value"))
    return rows.where("time is not null and var <> ''")


def hourly_point_series(long: DataFrame, *, fill: float = FILL, alarm: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """One row per location and time from (location_id, var, time, value), and the locations whose Tair is mostly missing."""
    real = F.when(F.col("value") > fill, F.col("value"))
    wide = long.withColumn("value", real).groupBy("location_id", "time").pivot("var", ["Tair", "Qair", "PSurf"]).agg(F.max("value"))
    share = wide.groupBy("location_id").agg(F.avg(F.col("Tair").isNull().cast("double")).alias("missing_share")).where(F.col("missing_share") > alarm)
    return wide, share


def hourly_reanalysis(raw: DataFrame, offsets: DataFrame | None = None, *, style: str = "cds") -> DataFrame:
    """Reanalysis rows: "cds" has valid_time, t2m, d2m, sp and whole hours are added; "region" has epoch milliseconds and keeps the offset as
    a column."""
    if style == "cds":
        t, air, dew, p = instant(F.col("valid_time").cast("string")), "t2m", "d2m", "sp"
    elif style == "region":
        t, air, dew, p = F.timestamp_millis(F.col("time")).cast("timestamp_ntz"), "temperature_2m", "dewpoint_temperature_2m", "surface_pressure"
    else:
        raise ValueError(f"style {style!r} is not known")
    rows = raw.select("location_id", t.alias("time"), number(F.col(air)).alias("Tair"), number(F.col(dew)).alias("d"), number(F.col(p)).alias("PSurf"))
    rows = rows.withColumn("Qair", specific_humidity(F.col("d") - KELVIN, F.col("PSurf") / 100)).where("Tair is not null and Qair is not null and PSurf is not null")
    columns = ["location_id", "time", "Tair", "Qair", "PSurf"]
    if offsets is not None:
        rows = rows.join(offsets.select("location_id", F.col("utc_offset_hours").cast("double").alias("utc_offset_hours")), "location_id")
        if style == "region":
            return rows.select(*columns, "utc_offset_hours")
        rows = rows.withColumn("time", shifted(F.col("time"), F.col("utc_offset_hours").cast("int")))
    return rows.select(*columns)


def hourly_grid_at_points(grid: DataFrame, points: DataFrame, *, fill: float = FILL) -> DataFrame:
    """The hours of each point's cell; a point without a cell (-1) has the times of the grid with nulls. Times that are null are none."""
    real = {c: F.when(F.col(c) > fill, F.col(c)) for c in ("Tair", "Qair", "PSurf")}
    inside = grid.where("time is not null").join(points.select("location_id", "iy", "ix"), ["iy", "ix"]).withColumns(real)
    columns = ["location_id", "time", *real]
    # a day's times travel as one row, so that the points meet days, by key, and no list of all times is sent to every task
    days = grid.where("time is not null").groupBy(F.to_date("time").alias("day")).agg(F.collect_set("time").alias("times"))
    period = grid.agg(F.expr("sequence(to_date(min(time)), to_date(max(time)))")).scalar()
    outside = points.where("iy < 0 or ix < 0").select("location_id", period.alias("period")).select("location_id", F.explode("period").alias("day")).join(days, "day")
    outside = outside.select("location_id", F.explode("times").alias("time"), *(F.lit(None).cast("double").alias(c) for c in real))
    return inside.select(*columns).unionByName(outside)
