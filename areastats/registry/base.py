"""Registration of queries and their checks."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.standins import check_sql, standin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """Stand-in views and raw tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_"):
            return standin(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, check: str | None = None):
    """Register a function of `Tables`; `check` is the same query as SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if check is not None:
            CHECKS[name] = check_sql(check)
        return fn

    return add


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Round double columns, so that summation order does not show."""
    return df.select(*[
        F.round(F.col(f"`{c}`"), places).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ])
