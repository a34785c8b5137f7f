"""Tables that a flow keeps for its later steps, in the folder that driver and executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this machine where it is unset and the master is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="recordloom-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: later plans start from a scan, and lost executors cost nothing.

    Its shuffles are finished then. Their files go when the driver's JVM collects its garbage, so it is asked to.
    """
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_kept(df: DataFrame) -> None:
    """Delete the files of a table made by kept() that no later plan reads."""
    spark = df.sparkSession
    for top in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if top.startswith("file:"):
            shutil.rmtree(top.partition(":")[2].replace("///", "/"), ignore_errors=True)
        else:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
