"""Every query over the driver tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from swelter.plans.fixtures import Tables, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of the tables as a query, with DuckDB SQL over the same views if there is any."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return build

    return register


from swelter.plans import archives, audits, backtests, catalogues, forecasts, gaps, geography, merges, observations, statistics  # noqa: E402, F401
