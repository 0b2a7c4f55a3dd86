"""Cut lineage and write intermediate tables where the driver and all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local master, whose executors are this process, gets a temporary one if it is unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="bindery-checkpoint-"))
    return sc.getCheckpointDir()


def new_table(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
