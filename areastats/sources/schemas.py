"""Explicit source schemas (DDL text), so that no read infers types."""

from areastats.constants import PRICE_COLUMNS

_PRICE_TYPES = {"price": "BIGINT", "date_of_transfer": "TIMESTAMP_NTZ"}
PRICE_SCHEMA = ", ".join(f"{c} {_PRICE_TYPES.get(c, 'STRING')}" for c in PRICE_COLUMNS)

LOOKUP_COLUMNS = ["lsoa_code_11", "lsoa_name_11", "lsoa_code_21", "lsoa_name_21", "lad_name"]

CRIME_SCHEMA = "lsoa_code STRING, category STRING, outcome_status STRING, month STRING"

CRIME_API_SCHEMA = "category STRING, outcome_status STRUCT<category: STRING>"

CUBE_SCHEMA = (
    "fields ARRAY<STRUCT<label: STRING, items: ARRAY<STRUCT<labels: ARRAY<STRING>>>>>, "
    "cubes MAP<STRING, STRUCT<values: ARRAY<ARRAY<STRING>>>>"
)

ELEMENT_SCHEMA = (
    "type STRING, id BIGINT, lon DOUBLE, lat DOUBLE, tags MAP<STRING, STRING>, "
    "geometry ARRAY<STRUCT<lon: DOUBLE, lat: DOUBLE>>"
)
MAP_RESPONSE_SCHEMA = f"elements ARRAY<STRUCT<{ELEMENT_SCHEMA}>>"
