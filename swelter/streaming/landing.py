"""Landed daily files merged into the partitioned table, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from swelter.operators.merge import merge_partitions


def merge_landed(spark: SparkSession, landing: str, root: str, checkpoint: str, *, schema: str = "location_id int, date date, wetbulb double, wetbulb_avg double, source string") -> StreamingQuery:
    """Start a run over all files that have landed since the last one; it ends by itself."""
    landed = spark.readStream.schema(schema).parquet(landing)
    return landed.writeStream.foreachBatch(lambda batch, _: merge_partitions(root, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
