"""What has landed: files, sizes, times."""

from pyspark.sql import DataFrame, functions as F


def file_inventory(df: DataFrame, source: str) -> DataFrame:
    """One row per file of a file-based frame, from scan metadata; no data column is read."""
    return (
        df.select("_metadata.file_path", "_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_path", "file_name", "file_size", "file_modification_time")
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(source).alias("source"),
            "file_path",
            "file_name",
            F.round(F.col("file_size") / 1048576, 2).alias("file_size_mb"),
            F.col("file_modification_time").alias("file_modified"),
            "n_rows",
        )
    )


def source_inventory(files: DataFrame) -> DataFrame:
    """One row per source: number of files, rows, total size, newest file."""
    return files.groupBy("source").agg(
        F.count("*").alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.round(F.sum("file_size_mb"), 2).alias("total_size_mb"),
        F.max("file_modified").alias("newest_file"),
    )
