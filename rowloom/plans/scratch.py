"""Tables written once and read back, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    A local session may set none and gets a temporary folder; on a cluster
    executors would each write to their own disk, so that is an error.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/rowloom-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
