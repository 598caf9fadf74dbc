"""What jobs take from the session: the shared folder and durable intermediate results."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only in local mode, where one machine does all."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage through files in the shared folder, so that the result outlives executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)
