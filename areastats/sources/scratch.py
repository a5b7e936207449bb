"""Folder for tables that one job writes and another reads."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder in spark.checkpoint.dir, or in the warehouse where that is unset.

    Both are folders that all executors share. It is removed when the driver's JVM ends. On a cluster, a
    warehouse on the driver's own disk is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/areastats-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    unset = spark.conf.get("spark.checkpoint.dir", None) is None
    if unset and files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write a table to a shared folder and read it back: computed once, lineage cut."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
