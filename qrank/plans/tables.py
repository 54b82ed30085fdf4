"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the session's shared folder; the folder goes when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The lineage ends there: what reads it twice does not compute it twice, a
    lost executor costs a re-read, and no executor holds it in memory.
    """
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for joins by shuffle.  Spark judges a written table by its compressed files; where
    rows repeat these say little of their number, and the driver would have to hold a broadcast of them."""
    return df.hint("merge")
