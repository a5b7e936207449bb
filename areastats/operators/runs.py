"""Many districts and snapshots in one job, and audits of what is stored."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.constants import FRESHNESS_DAYS
from areastats.functions.timewin import as_date, snapshots_covering, snapshots_covering_month


def plan_runs(snapshots: Sequence[str], districts: DataFrame) -> DataFrame:
    """(snapshot_date, district): every snapshot for every district."""
    dates = F.explode(F.array(*[as_date(s) for s in snapshots]))
    return districts.select("district").distinct().withColumn("snapshot_date", dates)


def pending_runs(runs: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs without a stored result."""
    keys = ["snapshot_date", "district"]
    return runs.join(stored.select(*keys).distinct(), keys, "left_anti")


def attach_snapshots(df: DataFrame, moment: Column, snapshots: Sequence[str], months: int) -> DataFrame:
    """One copy of a row per snapshot whose window holds it.

    The snapshots are a run argument, so each row filters a constant array: neither a
    range join nor a shuffle, and rows outside every window drop out at the scan.
    """
    days = [as_date(s) for s in snapshots]
    first = F.array_min(F.array(*[F.add_months(d, -months) for d in days]))
    last = F.array_max(F.array(*days))
    return df.filter(moment.between(first, last)).withColumn(
        "snapshot_date", F.explode(snapshots_covering(moment, snapshots, months))
    )


def attach_month_snapshots(df: DataFrame, month: Column, snapshots: Sequence[str], months: int) -> DataFrame:
    """`attach_snapshots` for rows that carry a yyyy-MM month."""
    days = [as_date(s) for s in snapshots]
    first = F.date_format(F.array_min(F.array(*[F.add_months(d, 1 - months) for d in days])), "yyyy-MM")
    last = F.date_format(F.array_max(F.array(*days)), "yyyy-MM")
    return df.filter(month.between(first, last)).withColumn(
        "snapshot_date", F.explode(snapshots_covering_month(month, snapshots, months))
    )


def missing_months(start: Column, end: Column, available: DataFrame, stored: DataFrame) -> DataFrame:
    """Requested months not stored yet, clipped to the available range.

    `available` and `stored` have a yyyy-MM `month` column; the result is ascending
    only when sorted by the caller.
    """
    bounds = available.agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.make_interval(months=F.lit(1)))
    requested = bounds.select(
        "_lo", "_hi", F.explode(F.transform(months, lambda d: F.date_format(d, "yyyy-MM"))).alias("month")
    )
    return (
        requested.filter(F.col("month").between(F.col("_lo"), F.col("_hi")))
        .join(stored.select("month").distinct(), "month", "left_anti")
        .select("month")
    )


def empty_months(expected: DataFrame, rows: DataFrame) -> DataFrame:
    """Expected months that hold no row."""
    return expected.select("month").distinct().join(rows.select("month").distinct(), "month", "left_anti")


def freshness(newest: DataFrame, as_of, limits: dict[str, int] = FRESHNESS_DAYS) -> DataFrame:
    """Age and state of each source; `newest` has source, cadence, newest (timestamp or date)."""
    allowed = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("cadence")]
    age = F.datediff(as_date(as_of), F.col("newest").cast("date"))
    return newest.select(
        "source", "cadence", age.alias("age_days"), allowed.alias("limit_days"), (age > allowed).alias("stale")
    )
