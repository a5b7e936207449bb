"""Benefit claim features per area.

Month means are weighted by rows: a month's sum counts once for every row of the month.
Written over an (area, month) pre-aggregate with its row count, which needs no window.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.constants import CLAIM_GROUPS
from areastats.functions.numbers import share
from areastats.operators.runs import attach_month_snapshots

KEYS = ("lsoa_code",)


def claim_months(claims: DataFrame, keys: Sequence[str] = KEYS, groups: dict[str, str] = CLAIM_GROUPS) -> DataFrame:
    """One row per (keys, month): rows, their sum, and the sum of each group."""
    group_sums = [
        F.coalesce(F.sum(F.when(F.col("condition_group") == g, F.col("value"))), F.lit(0)).alias(f"_{short}")
        for short, g in groups.items()
    ]
    return claims.groupBy(*keys, "month").agg(
        F.count("*").alias("_rows"), F.coalesce(F.sum("value"), F.lit(0)).alias("_all"), *group_sums
    )


def _totals(groups: dict[str, str]) -> list:
    return [F.sum("_all").alias("total_claims")] + [
        F.sum(f"_{s}").alias(f"total_{s}_claims") for s in groups
    ]


def _means(groups: dict[str, str]) -> list:
    def mean(col):
        return share(F.sum(F.col("_rows") * F.col(col)), F.sum("_rows"))

    return [mean("_all").alias("mean_monthly_claims")] + [
        mean(f"_{s}").alias(f"mean_monthly_{s}_claims") for s in groups
    ]


def claim_totals(claims: DataFrame, keys: Sequence[str] = KEYS, groups: dict[str, str] = CLAIM_GROUPS) -> DataFrame:
    return claim_months(claims, keys, groups).groupBy(*keys).agg(*_totals(groups))


def claim_monthly_means(
    claims: DataFrame, keys: Sequence[str] = KEYS, groups: dict[str, str] = CLAIM_GROUPS
) -> DataFrame:
    return claim_months(claims, keys, groups).groupBy(*keys).agg(*_means(groups))


def claim_shares(totals: DataFrame, groups: dict[str, str] = CLAIM_GROUPS) -> DataFrame:
    """Adds %_claims_{group} = group total / total."""
    for short in groups:
        totals = totals.withColumn(
            f"%_claims_{short}", share(F.col(f"total_{short}_claims"), F.col("total_claims"))
        )
    return totals


def claim_features(claims: DataFrame, keys: Sequence[str] = KEYS, groups: dict[str, str] = CLAIM_GROUPS) -> DataFrame:
    stats = claim_months(claims, keys, groups).groupBy(*keys).agg(*_totals(groups), *_means(groups))
    return claim_shares(stats, groups)


def claim_features_by_month(
    monthly: DataFrame, snapshots: Sequence[str], months: int, keys: Sequence[str] = KEYS, groups: dict[str, str] = CLAIM_GROUPS
) -> DataFrame:
    """`claim_features` of every snapshot's window from `claim_months`; late rows of a month may be rows of their own."""
    sums = ["_rows", "_all", *[f"_{short}" for short in groups]]
    whole = monthly.groupBy(*keys, "month").agg(*[F.sum(c).alias(c) for c in sums])
    windows = attach_month_snapshots(whole, F.col("month"), snapshots, months)
    return claim_shares(windows.groupBy("snapshot_date", *keys).agg(*_totals(groups), *_means(groups)), groups)
