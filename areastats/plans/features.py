"""Source pipelines: raw rows -> features keyed by snapshot, district and area.

Districts and snapshots are columns, so one job covers every run. Each pipeline
filters first, joins lookups that are already cut to the wanted districts, and aggregates once.
With several snapshots rows are aggregated by pane of time (sales) or month, and only those aggregates
are copied to the windows that hold them.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.functions.timewin import claim_month
from areastats.operators.claims import claim_features, claim_features_by_month, claim_months
from areastats.operators.crime import crime_counts, crime_features, crime_features_by_month
from areastats.operators.geography import attach_district, connectivity, districts_areas, names_to_codes
from areastats.operators.panes import PANE, window_pane
from areastats.operators.population import population_features, select_population_columns
from areastats.operators.prices import merge_cells, price_features, price_features_by_pane, sale_cells
from areastats.operators.runs import attach_month_snapshots, attach_snapshots

RUN_KEYS = ("snapshot_date", "district", "lsoa_code")
AREA_KEYS = ("district", "lsoa_code")


def spine_plan(lookup: DataFrame, snapshots: Sequence[str], districts: Sequence[str] | None = None) -> DataFrame:
    dates = F.explode(F.array(*[F.lit(s).cast("date") for s in snapshots]))
    return districts_areas(lookup, districts).select(dates.alias("snapshot_date"), "district", "lsoa_code")


def sales_with_area(
    prices: DataFrame, postcodes: DataFrame, lookup: DataFrame, districts: Sequence[str] | None = None
) -> DataFrame:
    """Sales of the wanted districts with district and lsoa_code instead of a postcode.

    The postcode table is cut to the districts first; a sale without a wanted area drops
    in either order, so the join can be an inner one. It is broadcast while it is below the
    threshold; beyond it sales are shuffled by postcode here, and again in the cells that the
    features count.
    """
    coded = attach_district(postcodes.select("postcode", "lsoa_code"), "lsoa_code", districts_areas(lookup, districts))
    return prices.drop("district").join(coded, "postcode").drop("postcode")


def price_plan(
    prices: DataFrame,
    postcodes: DataFrame,
    lookup: DataFrame,
    snapshots: Sequence[str],
    months: int = 12,
    districts: Sequence[str] | None = None,
    keys: Sequence[str] = RUN_KEYS,
) -> DataFrame:
    sales = sales_with_area(prices, postcodes, lookup, districts)
    moment = F.col("date_of_transfer")
    if len(snapshots) < 2 or "snapshot_date" not in keys:
        return price_features(attach_snapshots(sales, moment, snapshots, months), keys)
    areas = [k for k in keys if k != "snapshot_date"]
    paned = sales.withColumn(PANE, window_pane(moment, snapshots, months)).filter(F.col(PANE).isNotNull())
    cells = merge_cells(sale_cells(paned, [*areas, PANE]), [*areas, PANE])
    return price_features_by_pane(cells, snapshots, months, areas)


def crime_plan(
    crimes: DataFrame,
    lookup: DataFrame,
    snapshots: Sequence[str],
    months: int = 12,
    districts: Sequence[str] | None = None,
    keys: Sequence[str] = RUN_KEYS,
    **lists,
) -> DataFrame:
    """`lists` may override categories and outcomes. A district the crimes come with gives way
    to that of the lookup."""
    rows = attach_district(crimes.drop("district"), "lsoa_code", districts_areas(lookup, districts))
    if len(snapshots) < 2 or "snapshot_date" not in keys:
        return crime_features(attach_month_snapshots(rows, F.col("month"), snapshots, months), keys, **lists)
    areas = [k for k in keys if k != "snapshot_date"]
    return crime_features_by_month(crime_counts(rows, [*areas, "month"], **lists), snapshots, months, areas, **lists)


def claim_plan(
    claims: DataFrame,
    lookup: DataFrame,
    snapshots: Sequence[str],
    months: int = 12,
    districts: Sequence[str] | None = None,
    keys: Sequence[str] = RUN_KEYS,
) -> DataFrame:
    """`month` is yyyy-MM or a label such as december_2025, as the cubes have it."""
    coded = names_to_codes(claims.withColumn("month", claim_month(F.col("month"))), "lsoa_name", lookup)
    rows = attach_district(coded, "lsoa_code", districts_areas(lookup, districts))
    if len(snapshots) < 2 or "snapshot_date" not in keys:
        return claim_features(attach_month_snapshots(rows, F.col("month"), snapshots, months), keys)
    areas = [k for k in keys if k != "snapshot_date"]
    return claim_features_by_month(claim_months(rows, areas), snapshots, months, areas)


def population_plan(raw: DataFrame, lookup: DataFrame, districts: Sequence[str] | None = None) -> DataFrame:
    people = select_population_columns(raw)
    rows = attach_district(people, "lsoa_code", districts_areas(lookup, districts))
    return population_features(rows, AREA_KEYS)


def connectivity_plan(raw: DataFrame, lookup: DataFrame, districts: Sequence[str] | None = None) -> DataFrame:
    return connectivity(raw, districts_areas(lookup, districts))
