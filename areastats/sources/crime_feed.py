"""Shape landed crime files into (lsoa_code, month, category, outcome_status)."""

from pyspark.sql import Column, DataFrame, functions as F

from areastats.constants import CRIME_LABELS
from areastats.functions.text import relabel
from areastats.operators.geography import attach_district, recode_2011_2021
from areastats.sources.schemas import CRIME_API_SCHEMA


def label_crimes(df: DataFrame, col: str = "Crime type", labels: dict[str, str] = CRIME_LABELS) -> DataFrame:
    """Bulk label -> category name; other labels stay."""
    return df.withColumn(col, relabel(F.col(col), labels))


def merge_bulk_crime(
    street: DataFrame,
    outcomes: DataFrame | None,
    lookup: DataFrame,
    areas: DataFrame,
    labels: dict[str, str] = CRIME_LABELS,
) -> DataFrame:
    """Street crimes with their outcomes of the same month, on 2021 codes, for the wanted areas.

    Rows without a crime id drop; a crime with several outcomes gives several rows;
    without outcome files the outcome is null.
    """
    crimes = street.filter(F.col("Crime ID").isNotNull()).select(
        "month", "Crime ID", F.col("LSOA code").alias("lsoa_code"), "Crime type"
    )
    # Areas are filtered before the outcome join so that only wanted crimes are shuffled.
    wanted = attach_district(recode_2011_2021(crimes, "lsoa_code", lookup), "lsoa_code", areas)
    if outcomes is None:
        merged = wanted.withColumn("Outcome type", F.lit(None).cast("string"))
    else:
        known = outcomes.filter(F.col("Crime ID").isNotNull()).select("month", "Crime ID", "Outcome type")
        merged = wanted.join(known, ["month", "Crime ID"], "left")
    return label_crimes(merged, labels=labels).select(
        "month",
        "district",
        F.col("Crime type").alias("category"),
        "lsoa_code",
        F.col("Outcome type").alias("outcome_status"),
    )


def normalise_api_crimes(df: DataFrame, payload: Column) -> DataFrame:
    """JSON text of one crime per row -> typed columns; a null outcome parent gives null."""
    crime = F.from_json(payload, CRIME_API_SCHEMA)
    return df.select(
        "lsoa_code",
        "month",
        crime["category"].alias("category"),
        crime["outcome_status"]["category"].alias("outcome_status"),
    )
