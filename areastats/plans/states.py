"""Stored aggregates by area and month, from which any snapshot's features follow.

Landed rows are aggregated once and their aggregates appended to a month table (`sources/month_table.py`),
where those of late rows join those of earlier ones: counts and sums add up, and sales keep
their counts per price, so the order statistics stay exact. A snapshot reads the aggregates of its own months
and no raw row. `refresh` takes late rows in and rewrites just the snapshots whose windows hold one.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from areastats.functions.timewin import as_date, claim_month, snapshots_covering, snapshots_covering_month
from areastats.operators.claims import claim_features_by_month, claim_months
from areastats.operators.crime import crime_counts, crime_features_by_month
from areastats.operators.geography import attach_district, districts_areas, names_to_codes
from areastats.operators.panes import PANE, check_cut_days, month_pane
from areastats.operators.prices import merge_cells, price_features_by_pane, sale_cells
from areastats.plans.features import AREA_KEYS, sales_with_area
from areastats.sources import writers
from areastats.sources.month_table import append_months, read_months


@dataclass(frozen=True)
class Source:
    """How raw rows become aggregates with a month, these become features, and which snapshots a row touches."""

    name: str
    aggregates: Callable[[DataFrame], DataFrame]
    features: Callable[[DataFrame, Sequence[str], int], DataFrame]
    touches: Callable[[Sequence[str], int], Column]
    check: Callable[[Sequence[str]], None] = lambda snapshots: None


def sales_source(postcodes: DataFrame, lookup: DataFrame, cut_days: Sequence[int] = (1,)) -> Source:
    """Sales; snapshots must fall on one of the cut days of a month."""

    def aggregates(prices: DataFrame) -> DataFrame:
        sales = sales_with_area(prices, postcodes, lookup).withColumn(PANE, month_pane(F.col("date_of_transfer"), cut_days))
        keys = [*AREA_KEYS, PANE]
        cells = merge_cells(sale_cells(sales.filter(F.col(PANE).isNotNull()), keys), keys)
        return cells.withColumn("month", F.date_format(PANE, "yyyy-MM"))

    return Source(
        "prices", aggregates, lambda cells, snapshots, months: price_features_by_pane(cells, snapshots, months, AREA_KEYS),
        lambda snapshots, months: snapshots_covering(F.col("date_of_transfer"), list(snapshots), months),
        partial(check_cut_days, cut_days=cut_days),
    )


def crime_source(lookup: DataFrame, **lists) -> Source:
    """Crimes; `lists` may override categories and outcomes."""

    def aggregates(crimes: DataFrame) -> DataFrame:
        rows = attach_district(crimes.drop("district").filter(F.col("month").isNotNull()), "lsoa_code", districts_areas(lookup))
        return crime_counts(rows, [*AREA_KEYS, "month"], **lists)

    return Source(
        "crimes", aggregates, lambda counts, snapshots, months: crime_features_by_month(counts, snapshots, months, AREA_KEYS, **lists),
        lambda snapshots, months: snapshots_covering_month(F.col("month"), list(snapshots), months),
    )


def claim_source(lookup: DataFrame) -> Source:
    """Claims by area name; months are yyyy-MM or labels."""

    def aggregates(claims: DataFrame) -> DataFrame:
        rows = claims.withColumn("month", claim_month(F.col("month"))).filter(F.col("month").isNotNull())
        return claim_months(attach_district(names_to_codes(rows, "lsoa_name", lookup), "lsoa_code", districts_areas(lookup)), AREA_KEYS)

    return Source(
        "claims", aggregates, lambda monthly, snapshots, months: claim_features_by_month(monthly, snapshots, months, AREA_KEYS),
        lambda snapshots, months: snapshots_covering_month(claim_month(F.col("month")), list(snapshots), months),
    )


def add_rows(source: Source, rows: DataFrame, table: str, stream: str | None = None, batch: int | None = None) -> bool:
    """Aggregate rows and append them to their months; False for a batch of a stream that is stored already."""
    return append_months(source.aggregates(rows), table, stream, batch)


def land_rows(source: Source, rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """`add_rows` for all files that have arrived, each batch exactly once."""

    def add(batch: DataFrame, number: int) -> None:
        add_rows(source, batch, table, checkpoint, number)

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_features(
    spark: SparkSession, source: Source, table: str, schema, snapshots: Sequence[str], months: int = 12
) -> DataFrame:
    """Features of the snapshots, keyed by snapshot_date, district and lsoa_code, from the aggregates of their months.

    `schema` is that of the aggregates. Folders of months outside every window are not listed.
    """
    source.check(snapshots)
    return source.features(read_months(spark, table, schema, _months(spark, snapshots, months)), snapshots, months)


def refresh(
    source: Source, rows: DataFrame, table: str, folder: str, snapshots: Sequence[str], months: int = 12
) -> list[str]:
    """Take late rows in and replace the stored features (`writers.write_features`) of the snapshots they touch; return these.

    Other snapshots' partitions are neither read nor written. A run that fails after the rows are in is
    mended by calling `rewrite` for the same snapshots; calling this again would add the rows twice.
    """
    source.check(snapshots)
    touched = rows.select(F.explode(source.touches(snapshots, months)).alias("day")).distinct().collect()
    due = sorted(str(r.day) for r in touched)
    add_rows(source, rows, table)
    rewrite(source, rows.sparkSession, table, source.aggregates(rows).schema, folder, due, months)
    return due


def rewrite(source: Source, spark: SparkSession, table: str, schema, folder: str, snapshots: Sequence[str], months: int = 12) -> None:
    """Replace the stored features of some snapshots by those of the aggregates."""
    if snapshots:
        writers.write_features(window_features(spark, source, table, schema, snapshots, months), folder, source.name)


def _months(spark: SparkSession, snapshots: Sequence[str], months: int) -> list[str]:
    """Every month that a window touches, its first one included."""
    spans = [F.sequence(F.trunc(F.add_months(as_date(s), -months), "MM"), F.trunc(as_date(s), "MM"), F.make_interval(months=F.lit(1))) for s in snapshots]
    days = spark.range(1).select(F.explode(F.array_distinct(F.flatten(F.array(*spans)))).alias("day"))
    return [r.month for r in days.select(F.date_format("day", "yyyy-MM").alias("month")).collect()]
