"""Crime features per area: counts per category and outcome in one aggregation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.constants import CRIME_CATEGORIES, CRIME_OUTCOMES
from areastats.functions.numbers import row_sum, share
from areastats.operators.runs import attach_month_snapshots

KEYS = ("lsoa_code",)


def _counts(column: str, labels: Sequence[str]) -> list:
    return [F.count_if(F.col(column) == label).alias(label) for label in labels]


def crime_by_category(
    crimes: DataFrame, keys: Sequence[str] = KEYS, categories: Sequence[str] = CRIME_CATEGORIES
) -> DataFrame:
    """One count column per listed category; an area with only other categories keeps a row of zeros."""
    return crimes.groupBy(*keys).agg(*_counts("category", categories))


def crime_by_outcome(
    crimes: DataFrame, keys: Sequence[str] = KEYS, outcomes: Sequence[str] = CRIME_OUTCOMES
) -> DataFrame:
    """One count column per listed outcome; a missing outcome is not counted."""
    return crimes.groupBy(*keys).agg(*_counts("outcome_status", outcomes))


def crime_counts(
    crimes: DataFrame,
    keys: Sequence[str] = KEYS,
    categories: Sequence[str] = CRIME_CATEGORIES,
    outcomes: Sequence[str] = CRIME_OUTCOMES,
) -> DataFrame:
    """Both sets of counts. They share their keys, so no join is needed."""
    return crimes.groupBy(*keys).agg(
        *_counts("category", categories), *_counts("outcome_status", outcomes)
    )


def derive_crime_stats(
    counts: DataFrame,
    categories: Sequence[str] = CRIME_CATEGORIES,
    outcomes: Sequence[str] = CRIME_OUTCOMES,
) -> DataFrame:
    """total_crimes over the listed categories; resolution_rate = counted outcomes / total_crimes."""
    total = row_sum([F.col(f"`{c}`") for c in categories])
    resolved = row_sum([F.col(f"`{o}`") for o in outcomes])
    return counts.withColumn("total_crimes", total).withColumn(
        "resolution_rate", share(resolved, F.col("total_crimes"))
    )


def crime_features_by_month(
    monthly: DataFrame,
    snapshots: Sequence[str],
    months: int,
    keys: Sequence[str] = KEYS,
    categories: Sequence[str] = CRIME_CATEGORIES,
    outcomes: Sequence[str] = CRIME_OUTCOMES,
) -> DataFrame:
    """`crime_features` of every snapshot's window from `crime_counts` keyed by (keys, month); a month may have several rows."""
    windows = attach_month_snapshots(monthly, F.col("month"), snapshots, months)
    sums = [F.sum(f"`{label}`").alias(label) for label in (*categories, *outcomes)]
    return derive_crime_stats(windows.groupBy("snapshot_date", *keys).agg(*sums), categories, outcomes)


def crime_features(
    crimes: DataFrame,
    keys: Sequence[str] = KEYS,
    categories: Sequence[str] = CRIME_CATEGORIES,
    outcomes: Sequence[str] = CRIME_OUTCOMES,
) -> DataFrame:
    counts = crime_counts(crimes, keys, categories, outcomes)
    return derive_crime_stats(counts, categories, outcomes)
