"""Cutting lineage through shared storage, so that lost executors cost only a re-read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only for a local master."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidewire-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name on the shared storage."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read from there on.

    A columnar table rather than ``checkpoint()``: it is smaller, and later steps read
    only the columns they need.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "table")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
