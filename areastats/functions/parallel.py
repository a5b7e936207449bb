"""Sharing a shuffle between branches, and spreading rows that are about to be multiplied."""

from pyspark.sql import DataFrame, functions as F


def shared(df: DataFrame) -> DataFrame:
    """An aggregate that several branches of one query use.

    Each branch needs other columns and other null checks. The inline keeps the
    optimizer from pushing these differences below the aggregation, so that Spark sees
    one and the same shuffle everywhere and runs it once (ReusedExchange in the plan).
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Repartition to a fixed count, at least one partition per core.

    AQE packs shuffle partitions by their bytes. Before a join that turns each small row
    into hundreds of measured pairs, bytes say nothing about the work, so the count is
    fixed here; only aggregated (small) rows are moved.
    """
    session = df.sparkSession
    shuffle = session.conf.get("spark.sql.shuffle.partitions", "200")
    cores = session.sparkContext.defaultParallelism
    count = max(cores, int(shuffle)) if shuffle.isdigit() else cores
    return df.repartition(count, *columns)
