"""Statistics-cube responses to long rows."""

from pyspark.sql import Column, DataFrame, functions as F

from areastats.constants import CUBE_AREA_FIELD, CUBE_MONTH_FIELD
from areastats.sources.schemas import CUBE_SCHEMA


def _labels(fields: Column, name: str) -> Column:
    """Labels of every item of the fields called `name`, in order."""
    items = F.flatten(F.transform(F.filter(fields, lambda f: f["label"] == name), lambda f: f["items"]))
    return F.flatten(F.transform(items, lambda i: i["labels"]))


def flatten_cubes(
    responses: DataFrame,
    payload: Column,
    month_field: str = CUBE_MONTH_FIELD,
    area_field: str = CUBE_AREA_FIELD,
) -> DataFrame:
    """One response per row (with its condition_group) -> lsoa_name, month, value, condition_group.

    A cell is a number or a one-element list; cells are read as text, so both parse the same way.
    """
    cube = F.from_json(payload, CUBE_SCHEMA)
    parsed = responses.select("condition_group", cube.alias("cube")).select(
        "condition_group",
        F.transform(
            _labels(F.col("cube.fields"), month_field), lambda m: F.lower(F.replace(m, F.lit(" "), F.lit("_")))
        ).alias("months"),
        _labels(F.col("cube.fields"), area_field).alias("areas"),
        F.map_values("cube.cubes")[0]["values"].alias("rows"),
    )
    rows = parsed.select("condition_group", "months", "areas", F.posexplode("rows").alias("r", "cells"))
    cells = rows.select(
        "condition_group", "months", F.col("areas")[F.col("r")].alias("lsoa_name"), F.posexplode("cells").alias("c", "cell")
    )
    return cells.select(
        "lsoa_name",
        F.col("months")[F.col("c")].alias("month"),
        F.expr("try_cast(trim(split_part(btrim(cell, '[] '), ',', 1)) AS DOUBLE)").alias("value"),
        "condition_group",
    )
