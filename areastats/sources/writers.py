"""Table and lookup sinks."""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.functions.text import district_slug
from areastats.sources.month_table import replace_months


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions present in `df`.

    The rebalance hint lets AQE split a partition value that holds most of the rows
    over several files and pack small ones together.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_verified(df: DataFrame, path: str, by: Sequence[str], verify: Callable[[], None]) -> None:
    """Like `write_partitioned`, but nothing is replaced unless `verify`, called after the write, returns.

    The rows go to a folder that readers of the table skip; partitions are then swapped in by
    renaming. A failed write or check leaves the table as it was.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = hadoop.Path(root, f"_draft-{uuid.uuid4().hex}")
    new, old = hadoop.Path(draft, "new"), hadoop.Path(draft, "old")

    def partitions(folder, names: tuple[str, ...] = ()):
        if len(names) == len(by):
            yield "/".join(names)
            return
        for status in files.listStatus(folder):
            if status.isDirectory() and "=" in status.getPath().getName():
                yield from partitions(status.getPath(), (*names, status.getPath().getName()))

    try:
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(new.toString())
        verify()
        for name in partitions(new):
            target = hadoop.Path(root, name)
            files.mkdirs(target.getParent())
            if files.exists(target):
                aside = hadoop.Path(old, name)
                files.mkdirs(aside.getParent())
                if not files.rename(target, aside):
                    raise OSError(f"cannot move {target.toString()}")
            if not files.rename(hadoop.Path(new, name), target):
                files.rename(hadoop.Path(old, name), target)
                raise OSError(f"cannot move into {target.toString()}")
    finally:
        files.delete(draft, True)


def _slugged(df: DataFrame) -> DataFrame:
    return df.withColumn("district_slug", district_slug(F.col("district")))


def write_results(df: DataFrame, path: str, verify: Callable[[], None] | None = None) -> None:
    """Combined table, one partition per snapshot and district; with `verify`, replaced only where that returns."""
    by = ["snapshot_date", "district_slug"]
    if verify is None:
        write_partitioned(_slugged(df), path, by)
    else:
        write_verified(_slugged(df), path, by, verify)


def write_features(df: DataFrame, folder: str, source: str) -> None:
    """One source's feature table, laid out like the combined one."""
    write_results(df, f"{folder}/{source}")


def write_months(df: DataFrame, path: str) -> None:
    """Monthly tables (crime, claims): the months of `df` are replaced in one commit, other months stay."""
    replace_months(df, path)


def write_lookup_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
