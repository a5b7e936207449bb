"""Whole runs: every source's features for all wanted snapshots and districts, combined and written."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.constants import BUFFER_DISTANCES
from areastats.functions.text import district_slug
from areastats.operators.combine import CheckedCombination, combine_checked
from areastats.operators.areas import check_srid, with_edges
from areastats.operators.geography import attach_district, districts_areas
from areastats.operators.spatial import map_features
from areastats.plans import features
from areastats.sources import map_elements, readers, scratch, writers


@dataclass
class Inputs:
    """Landed tables; a source left out is left out of the result."""

    lookup: DataFrame
    prices: DataFrame | None = None
    postcodes: DataFrame | None = None
    crimes: DataFrame | None = None
    claims: DataFrame | None = None
    population: DataFrame | None = None
    connectivity: DataFrame | None = None
    boundaries: DataFrame | None = None  # lsoa_code, polygons in metres; srid, where there is one, is checked
    elements: DataFrame | None = None  # map elements in lon / lat; with snapshot_date, one map per snapshot
    boxes: DataFrame | None = None  # boxes in degrees by district (areas.district_bbox, any buffer); ways beyond the largest buffer of them are skipped
    landuse_types: Sequence[str] | None = None


def feature_frames(
    raw: Inputs, snapshots: Sequence[str], months: int = 12, districts: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Feature frame of every source that is present, by name."""
    out = {}
    if raw.crimes is not None:
        out["crimes"] = features.crime_plan(raw.crimes, raw.lookup, snapshots, months, districts)
    if raw.claims is not None:
        out["claims"] = features.claim_plan(raw.claims, raw.lookup, snapshots, months, districts)
    if raw.connectivity is not None:
        out["connectivity"] = features.connectivity_plan(raw.connectivity, raw.lookup, districts)
    if raw.prices is not None:
        out["prices"] = features.price_plan(raw.prices, raw.postcodes, raw.lookup, snapshots, months, districts)
    if raw.elements is not None:
        boundaries = check_srid(raw.boundaries) if "srid" in raw.boundaries.columns else raw.boundaries
        shapes = attach_district(boundaries.drop("district"), "lsoa_code", districts_areas(raw.lookup, districts))
        elements = raw.elements
        if raw.boxes is not None:
            wanted = districts_areas(raw.lookup, districts).select("district").distinct()
            boxes = raw.boxes.join(wanted, "district", "left_semi")
            elements = map_elements.near_boxes(elements, boxes, max(BUFFER_DISTANCES), nodes=False)
        out["map"] = _per_snapshot(elements, snapshots, lambda e: _map_frame(shapes, e, raw.landuse_types))
    if raw.population is not None:
        out["population"] = _per_snapshot(
            raw.population, snapshots, lambda p: features.population_plan(p, raw.lookup, districts)
        )
    return out


def _per_snapshot(rows: DataFrame, snapshots: Sequence[str], plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One frame for all snapshots, or, where the rows have a snapshot_date, one of each snapshot's own rows.

    The plans of different snapshots share no rows, so nothing is gained by one plan for all.
    """
    if "snapshot_date" not in rows.columns:
        return plan(rows)
    frames = []
    for s in snapshots:
        day = F.lit(s).cast("date")
        frames.append(plan(rows.filter(F.col("snapshot_date") == day).drop("snapshot_date")).withColumn("snapshot_date", day))
    return reduce(DataFrame.unionByName, frames)


def _map_frame(shapes: DataFrame, elements: DataFrame, landuse_types: Sequence[str] | None) -> DataFrame:
    points, polygons, lines = map_elements.split_elements(elements)
    return map_features(
        with_edges(shapes, features.AREA_KEYS),
        map_elements.points_to_grid(points),
        map_elements.ways_to_grid(polygons),
        map_elements.ways_to_grid(lines),
        features.AREA_KEYS,
        landuse_types=landuse_types,
    )


def _dated(frame: DataFrame, snapshots: Sequence[str]) -> DataFrame:
    """Give a frame without a snapshot one copy per snapshot, so that it can be stored like the others."""
    if "snapshot_date" in frame.columns:
        return frame
    return frame.withColumn("snapshot_date", F.explode(F.array(*[F.lit(s).cast("date") for s in snapshots])))


def run(
    raw: Inputs,
    output: str,
    snapshots: Sequence[str],
    months: int = 12,
    districts: Sequence[str] | None = None,
    features_folder: str | None = None,
) -> None:
    """One job for all snapshots and districts; replaces exactly their partitions.

    Each source's table is stored first and read back. The combined table is checked by counts taken while
    it is written, and replaces stored partitions only if they are right. The source tables lie in `features_folder`, or else in a fresh folder under
    spark.checkpoint.dir (the warehouse where that is unset).
    """
    spark = raw.lookup.sparkSession
    folder = features_folder or scratch.shared_folder(spark)
    frames = feature_frames(raw, snapshots, months, districts)
    for name, frame in frames.items():
        writers.write_features(_dated(frame, snapshots), folder, name)
    made = CheckedCombination(features.spine_plan(raw.lookup, snapshots, districts), *_stored(spark, folder, list(frames), snapshots), keys=features.RUN_KEYS)
    writers.write_results(made.rows, output, made.verify)


def _stored(spark: SparkSession, folder: str, sources: Sequence[str], snapshots: Sequence[str]) -> list[DataFrame]:
    wanted = F.col("snapshot_date").isin([F.lit(s).cast("date") for s in snapshots])
    return [readers.read_features(spark, folder, s).filter(wanted) for s in sources]


def from_stored(
    spark: SparkSession,
    folder: str,
    sources: Sequence[str],
    lookup: DataFrame,
    snapshots: Sequence[str],
    districts: Sequence[str] | None = None,
) -> DataFrame:
    """Combined table from stored per-source tables."""
    return combine_checked(features.spine_plan(lookup, snapshots, districts), *_stored(spark, folder, sources, snapshots), keys=features.RUN_KEYS)


def run_pending(
    raw: Inputs,
    output: str,
    snapshots: Sequence[str],
    months: int = 12,
    districts: Sequence[str] | None = None,
    features_folder: str | None = None,
) -> list[str]:
    """Run the snapshots that some wanted district has no stored result for; return them.

    Only partition values are read: snapshots and districts, not rows.
    """
    areas = districts_areas(raw.lookup, districts)
    wanted = areas.select(district_slug(F.col("district")).alias("district_slug")).distinct().withColumn(
        "snapshot_date", F.explode(F.array(*[F.lit(s).cast("date") for s in snapshots]))
    )
    try:
        stored = readers.read_table(raw.lookup.sparkSession, output).select("snapshot_date", "district_slug").distinct()
        wanted = wanted.join(stored, ["snapshot_date", "district_slug"], "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # nothing stored yet
    due = sorted(str(r.snapshot_date) for r in wanted.select("snapshot_date").distinct().collect())
    if due:
        run(raw, output, due, months, districts, features_folder)
    return due
