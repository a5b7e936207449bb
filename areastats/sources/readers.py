"""Scans of landed files."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.functions.timewin import in_window, month_in_window
from areastats.sources.month_table import is_month_table, read_months
from areastats.sources.schemas import CRIME_SCHEMA, LOOKUP_COLUMNS, PRICE_SCHEMA


def file_years(snapshot: str, months: int) -> list[int]:
    """Years a window touches, from its arguments alone, to choose files before the scan."""
    end = date.fromisoformat(snapshot)
    first = (end.year * 12 + end.month - 1 - months) // 12
    return list(range(first, end.year + 1))


def read_prices(spark: SparkSession, folder: str, snapshot: str | None = None, months: int = 12) -> DataFrame:
    """Header-less yearly sale files ('..._2025.csv'). With a snapshot, only the window's
    files are listed and only its rows kept."""
    reader = spark.read.schema(PRICE_SCHEMA).option("timestampNTZFormat", "yyyy-MM-dd HH:mm")
    if snapshot is None:
        return reader.csv(folder)
    years = ",".join(str(y) for y in file_years(snapshot, months))
    sales = reader.option("pathGlobFilter", f"*{{{years}}}.csv").csv(folder)
    return sales.filter(in_window(F.col("date_of_transfer"), snapshot, months))


def read_crime(spark: SparkSession, folder: str, snapshot: str | None = None, months: int = 12) -> DataFrame:
    """Crime table partitioned by month, with commits or without; a window prunes partitions."""
    committed = is_month_table(spark, folder)
    crimes = read_months(spark, folder, CRIME_SCHEMA) if committed else spark.read.schema(CRIME_SCHEMA).parquet(folder)
    if snapshot is None:
        return crimes
    return crimes.filter(month_in_window(F.col("month"), snapshot, months))


def read_area_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Area lookup with a header; columns are matched by name."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(c) for c in LOOKUP_COLUMNS if c in raw.columns])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_bulk_csv(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Bulk crime files of one kind ('street' or 'outcomes'), all text, from <yyyy-MM>/ folders.

    `month` comes from the folder name.
    """
    month = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2})/[^/]*$", 1)
    return (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{kind}*.csv")
        .csv(folder)
        .withColumn("month", month)
    )


def read_features(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """A stored per-source feature table; filters on snapshot_date or district_slug prune partitions."""
    stored = spark.read.parquet(f"{folder}/{source}")
    return stored.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).drop("district_slug")
