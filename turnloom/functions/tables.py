"""Intermediate tables that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); where it is unset, a temporary one of a local master, else an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        if at.isDefined():
            return at.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = f"file://{tempfile.mkdtemp(prefix='turnloom-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    Later stages then neither recompute it nor lose it with an executor, and the
    planner knows its true size.  The table goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.parquet(path)
