"""Incremental landing of monthly files.

A file-source stream with `availableNow` replaces "skip what is already stored": the
checkpoint remembers processed files, the month table takes each batch exactly once,
and both survive lost executors and restarts.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from areastats.sources.month_table import append_months


def stream_files(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "parquet", max_files: int = 1000
) -> DataFrame:
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True)
        .load(folder)
    )


def without_stored(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows that were stored by other means than this stream, by the keys that name a row.

    The checkpoint already keeps a file from being taken twice, so a late file of a month that
    is stored lands like any other; only rows that are stored themselves drop.
    """
    known = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys])
    return rows.join(known, same, "left_anti")


def land_months(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append all files that have arrived to a month table, then stop.

    Each batch is one commit that carries its number, so a batch that is repeated after a failure adds
    nothing; what other writers have stored in the table stays.
    """

    def append(batch: DataFrame, number: int) -> None:
        append_months(batch, table, stream=checkpoint, batch=number)

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
