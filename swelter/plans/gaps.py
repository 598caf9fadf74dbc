"""Queries of gap detection and filling."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from swelter.operators import gaps
from swelter.plans.observations import HOURLY, _hourly, daily_sql
from swelter.plans.registry import query

START, END, AS_OF = datetime.date(1990, 1, 1), datetime.date(2026, 12, 31), datetime.date(2026, 1, 5)
CELLS = "SELECT id AS location_id, d AS date FROM {locations} CROSS JOIN {days}"
MISSING = f"SELECT c.location_id, c.date FROM ({CELLS}) c ANTI JOIN (SELECT * FROM {{dense_daily}} WHERE source NOT IN ('nldas', 'era5land', 'giovanni')) USING (location_id, date)"
MISSING_ALL = f"SELECT c.location_id, c.date FROM ({CELLS}) c ANTI JOIN {{dense_daily}} USING (location_id, date)"


def _missing(t, fill):
    return gaps.missing_cells(t.locations, t.dense_daily, start=START, end=END, as_of=AS_OF, include_fill=fill)


@query("f1_missing_cells", MISSING_ALL)
def _(t):
    return _missing(t, True)


@query("f1_missing_station_cells", f"SELECT location_id, CAST(year(date) AS INT) AS year, count(*) AS n FROM ({MISSING}) GROUP BY 1, 2")
def _(t):
    return _missing(t, False).groupBy("location_id", F.year("date").alias("year")).agg(F.count("*").alias("n"))


@query("f2_material_gaps", f"SELECT * FROM ({MISSING_ALL}) QUALIFY count(*) OVER (PARTITION BY location_id, year(date)) >= 19")
def _(t):
    return gaps.material_gaps(_missing(t, True))


RANGES = f"SELECT location_id, CAST(min(y) AS INT) AS start_year, CAST(max(y) AS INT) AS end_year FROM (SELECT *, y - row_number() OVER (PARTITION BY location_id ORDER BY y) AS g FROM (SELECT DISTINCT location_id, year(date) AS y FROM (SELECT * FROM ({MISSING_ALL}) WHERE year(date) % 5 <> location_id % 5))) GROUP BY location_id, g"


def _ranges(t):
    return gaps.gap_year_ranges(_missing(t, True).where(F.year("date") % 5 != F.col("location_id") % 5))


@query("f3_gap_year_ranges", RANGES)
def _(t):
    return _ranges(t)


@query("f4_fill_gaps", f"{daily_sql(HOURLY, 'location_id', 12)} SELECT location_id, date, wetbulb, wetbulb_avg, 'nldas' AS source FROM dy WHERE (location_id + day(date)) % 3 = 0")
def _(t):
    days = t.hourly_obs.select("location_id", F.col("time").cast("date").alias("date")).distinct()
    wanted = days.where((F.col("location_id") + F.day("date")) % 3 == 0)
    return gaps.fill_gaps(_hourly(t), wanted, source="nldas", min_daily_hours=12)


#: A gap range is recovered if some fetched span contains it; spans are runs of up to six years.
CONTAINED = f"SELECT r.*, EXISTS (SELECT 1 FROM {{snapshot_spans}} s WHERE s.location_id = r.location_id AND s.start_year <= r.start_year AND s.end_year >= r.end_year) AS there FROM ({RANGES}) r"


@query("f5_span_recovery_report", f"SELECT location_id, count(*) AS expected, count(*) FILTER (there) AS recovered, bool_and(there) AS complete FROM ({CONTAINED}) GROUP BY 1")
def _(t):
    return gaps.span_recovery_report(_ranges(t), t.snapshot_spans, allow_partial=True)


@query("f5_recovered_cells", f"SELECT location_id, date FROM ({MISSING_ALL}) m WHERE year(date) % 5 <> location_id % 5 AND EXISTS (SELECT 1 FROM ({CONTAINED}) c WHERE c.there AND c.location_id = m.location_id AND year(m.date) BETWEEN c.start_year AND c.end_year)")
def _(t):
    missing = _missing(t, True).where(F.year("date") % 5 != F.col("location_id") % 5)
    return gaps.recovered_cells(missing, t.snapshot_spans, allow_partial=True)
