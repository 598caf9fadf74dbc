"""Views with the shapes of the domain, derived from the driver's tables in SQL that Spark and DuckDB both run.

Values come from integer arithmetic and one division, so both engines see the same doubles. ``{name}`` stands for a table or
another view, ``[[days a b]]`` for all days between two dates, ``[[ints a b]]`` for whole numbers, ``[[dayno d]]`` for the days since
1990-01-01.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Inventory numbers of the stations near a city, and so on, are plain functions of the keys.
FIXTURES: dict[str, str] = {
    "locations": """
        SELECT CAST(CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE 1000 + s_suppkey END AS INT) AS id, CAST(s_suppkey AS INT) AS k, s_name AS city, n_name AS state,
            30 + CAST(s_suppkey * 37 % 2000 AS DOUBLE) / 100 AS lat, -120 + CAST(s_suppkey * 91 % 5000 AS DOUBLE) / 100 AS lng
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "days": "[[days 1990-01-01 2025-12-31]]",
    "dense_all": """
        SELECT id AS location_id, k, d AS date, (k * 7919 + [[dayno d]] * 104729) % 1000 AS h, 100 + k % 7 * 10 + (6 - abs(month(d) - 7)) * 15 + (year(d) - 1990) AS base
        FROM {locations} CROSS JOIN {days}""",
    "dense_daily": """
        SELECT location_id, date, CAST(base + h % 50 AS DOUBLE) / 10 AS wetbulb, CAST(base + h % 50 - 20 - h % 30 AS DOUBLE) / 10 AS wetbulb_avg,
            CASE h % 5 WHEN 0 THEN 'eccc' WHEN 1 THEN 'ghcnh' WHEN 2 THEN 'isd' WHEN 3 THEN 'nldas' ELSE 'era5land' END AS source,
            CASE WHEN h % 5 < 3 THEN CAST(20 + h % 5 AS INT) END AS observed_hours
        FROM {dense_all} WHERE h >= 10 + k % 3 * 30""",
    "snapshot_spans": """
        SELECT location_id, CAST(min(y) AS INT) AS start_year, CAST(max(y) AS INT) AS end_year FROM (SELECT location_id, y, y - row_number() OVER (PARTITION BY location_id ORDER BY y) AS g
            FROM (SELECT DISTINCT location_id, year(date) AS y FROM {dense_daily}) x WHERE (y + location_id) % 7 <> 0) z GROUP BY location_id, g""",
    "gmst_obs": "SELECT v AS year, CAST((v - 1990) * 25 + v * 37 % 11 * 10 AS DOUBLE) / 1000 AS anomaly FROM ([[ints 1990 2025]]) y",
    "scenario_rates": "SELECT 'ssp126' AS scenario, 10 AS rate UNION ALL SELECT 'ssp245', 20 UNION ALL SELECT 'ssp370', 30",
    "gmst_scen": "SELECT scenario, v AS year, CAST(900 + (v - 2025) * rate AS DOUBLE) / 1000 AS anomaly, CAST(0.1 AS DOUBLE) AS sigma_g FROM {scenario_rates} CROSS JOIN ([[ints 2026 2100]]) y",
    "station_groups": "SELECT id AS location_id, 'g' || CAST(k % 20 AS VARCHAR(4)) AS station_group FROM {locations} WHERE k % 2 = 0",
    "calib": "SELECT 'avg_wetbulb' AS metric, CAST(1.0 AS DOUBLE) AS calibration_factor UNION ALL SELECT 'max_wetbulb', CAST(1.2 AS DOUBLE) UNION ALL SELECT 'avg_wetbulb_avg', CAST(1.0 AS DOUBLE) UNION ALL SELECT 'max_wetbulb_avg', CAST(1.2 AS DOUBLE)",
    "hourly_obs": """
        SELECT CAST(user_id % 5 AS INT) AS location_id, CAST(user_id % 3 AS VARCHAR(4)) AS station_id, CAST(ts AS [[ntz]]) AS time, event_id,
            CAST(event_id * 7919 % 400 AS DOUBLE) / 10 - 5 AS tair_c, CAST(event_id * 7919 % 400 - event_id % 120 AS DOUBLE) / 10 - 5 AS dewpoint_c, CAST(950 + event_id % 90 AS DOUBLE) AS pressure_hpa
        FROM {events}""",
    "candidates_raw": """
        SELECT CAST(l_suppkey % 10 AS INT) AS location_id, CAST(l_partkey % 3 AS INT) AS s, CAST(l_shipdate AS DATE) AS date, min(l_orderkey) AS o
        FROM {lineitem} GROUP BY 1, 2, 3""",
    "candidates_daily": """
        SELECT location_id, 's' || CAST(s AS VARCHAR(2)) AS station_id, 's0' AS reference_station_id, date,
            CAST([[dayno date]] * 31 % 200 + CASE WHEN s = 0 THEN 0 WHEN s = 1 THEN 15 WHEN location_id % 2 = 0 THEN 70 ELSE 25 END + o % 3 AS DOUBLE) / 10 AS wetbulb,
            CAST([[dayno date]] * 31 % 200 - 30 + CASE WHEN s = 0 THEN 0 WHEN s = 1 THEN 12 WHEN location_id % 2 = 0 THEN 66 ELSE 20 END + o % 3 AS DOUBLE) / 10 AS wetbulb_avg,
            CAST(20 + o % 5 AS INT) AS observed_hours, CAST(5 + s * 7 AS DOUBLE) AS station_distance_km, CAST(90 - s * 10 AS DOUBLE) / 100 AS variable_coverage
        FROM {candidates_raw}""",
    "cities_geo": """
        SELECT CAST(c_custkey AS INT) AS location_id, c_name AS city, 30 + CAST(c_custkey * 37 % 2000 AS DOUBLE) / 100 AS lat, -120 + CAST(c_custkey * 91 % 5000 AS DOUBLE) / 100 AS lng,
            CAST(c_custkey * 13 % 900 AS DOUBLE) AS dem_m, CAST(c_custkey * 7919 % 100000 AS BIGINT) AS population, CAST(c_nationkey AS INT) AS country
        FROM {customer}""",
    "stations_geo": """
        SELECT 'P' || CAST(p_partkey AS VARCHAR(12)) AS station_id, CAST(p_partkey AS INT) AS pk, 30 + CAST(p_partkey * 53 % 2000 AS DOUBLE) / 100 AS lat, -120 + CAST(p_partkey * 71 % 5000 AS DOUBLE) / 100 AS lon,
            CAST(p_partkey * 17 % 900 AS DOUBLE) AS elev_m, CAST(1980 + p_partkey % 30 AS INT) AS begin_year, CAST(2000 + p_partkey % 26 AS INT) AS end_year
        FROM {part}""",
    "station_scores": "SELECT station_id, CAST(pk % 100 AS DOUBLE) / 100 AS score FROM {stations_geo} WHERE pk % 100 > 0",
    "availability": "SELECT station_id, v AS year FROM {stations_geo} CROSS JOIN ([[ints 1990 2025]]) y WHERE (pk + v) % 4 <> 0",
    "grid_rows": "SELECT v AS iy FROM ([[ints 0 159]]) y",
    "grid_cells": "SELECT iy, v AS ix, (iy * 7 + v * 13) % 5 <> 0 AS land FROM {grid_rows} CROSS JOIN ([[ints 0 399]]) x",
}

_NATIVE = {
    "spark": {
        "days": lambda a, b: f"SELECT explode(sequence(DATE'{a}', DATE'{b}')) AS d",
        "ints": lambda a, b: f"SELECT explode(sequence({a}, {b})) AS v",
        "dayno": lambda d: f"CAST(datediff({d}, DATE'1990-01-01') AS BIGINT)",
        "ntz": lambda: "TIMESTAMP_NTZ",
    },
    "duckdb": {
        "days": lambda a, b: f"SELECT CAST(unnest(generate_series(DATE '{a}', DATE '{b}', INTERVAL 1 DAY)) AS DATE) AS d",
        "ints": lambda a, b: f"SELECT CAST(unnest(generate_series({a}, {b})) AS INT) AS v",
        "dayno": lambda d: f"({d} - DATE '1990-01-01')",
        "ntz": lambda: "TIMESTAMP",
    },
}


def _native(sql: str, engine: str) -> str:
    return re.sub(r"\[\[(\w+)((?: [\w-]+)*)\]\]", lambda m: _NATIVE[engine][m[1]](*m[2].split()), sql)


class Tables:
    """The driver's tables and the views above, as DataFrames by name."""

    def __init__(self, spark: SparkSession, sf_dir: str, locations_a_task: int | None = None):
        self.spark, self.sf_dir, self.locations_a_task = spark, sf_dir, locations_a_task

    def fine(self, locations_a_task: int = 100) -> Tables:
        """The same with more tasks where there are many locations, for jobs that sort the days: a hundred locations are 1.3 million."""
        return Tables(self.spark, self.sf_dir, locations_a_task)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in FIXTURES:
            return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        sql = re.sub(r"VARCHAR\(\d+\)", "STRING", _native(FIXTURES[name], "spark"))
        views = {n: getattr(self, n) for n in set(re.findall(r"\{(\w+)\}", sql))}
        if name == "dense_all":
            views["locations"] = self._dealt(views["locations"])
        return self.spark.sql(sql, **views)

    def _dealt(self, locations: DataFrame) -> DataFrame:
        """Few bytes of locations become all days, so they are dealt to all tasks by id; what is grouped by location is then at hand in one
        task without another exchange. Products with the key are beyond 32 bits from some 97,000 suppliers on."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if self.locations_a_task:
            tasks = max(tasks, -(-self.supplier.count() // self.locations_a_task))
        return locations.withColumn("k", F.col("k").cast("long")).repartition(tasks, "id")


def with_fixtures(sql: str) -> str:
    """DuckDB SQL with the views it names put in front of it."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            if name in FIXTURES and name not in order:
                need(FIXTURES[name])
                order.append(name)

    need(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", _native(text, "duckdb"))
    body = plain(sql).strip()
    if not order:
        return body
    views = ",\n".join(f"{n} AS ({plain(FIXTURES[n])})" for n in order)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {body[15:]}"
    return f"WITH {views}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"
