"""Conform rows to areas: codes, names, postcodes, districts.

No join carries a broadcast hint: Spark broadcasts a lookup when its size is under
`spark.sql.autoBroadcastJoinThreshold` (at planning time or, under AQE, after the
real size is known) and otherwise shuffles, where AQE splits skewed keys.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def districts_areas(lookup: DataFrame, districts: Sequence[str] | None = None) -> DataFrame:
    """Distinct (district, lsoa_code) of the named districts, or of all."""
    if districts is not None:
        lookup = lookup.filter(F.col("lad_name").isin(list(districts)))
    return lookup.select(
        F.col("lad_name").alias("district"), F.col("lsoa_code_21").alias("lsoa_code")
    ).distinct()


def target_codes(lookup: DataFrame, district: str) -> DataFrame:
    """Area codes of a district as listed (a code repeats when the lookup repeats it)."""
    return lookup.filter(F.col("lad_name") == district).select(F.col("lsoa_code_21").alias("lsoa_code"))


def area_spine(lookup: DataFrame, district: str) -> DataFrame:
    return target_codes(lookup, district).distinct()


def filter_areas(df: DataFrame, code_col: str, district: str, lookup: DataFrame) -> DataFrame:
    """Keep rows of one district's areas; the code column becomes lsoa_code."""
    codes = area_spine(lookup, district).withColumnRenamed("lsoa_code", code_col)
    return df.join(codes, code_col, "left_semi").withColumnRenamed(code_col, "lsoa_code")


def attach_district(df: DataFrame, code_col: str, areas: DataFrame) -> DataFrame:
    """`filter_areas` for many districts at once: rows keep their district as a column."""
    codes = areas.select("district", F.col("lsoa_code").alias(code_col))
    return df.join(codes, code_col).withColumnRenamed(code_col, "lsoa_code")


def recode_2011_2021(df: DataFrame, col: str, lookup: DataFrame, by: str = "code") -> DataFrame:
    """Replace 2011 codes (or names) by 2021 ones. Unmapped values stay; a split area fans out."""
    mapping = lookup.select(
        F.col(f"lsoa_{by}_11").alias(col), F.col(f"lsoa_{by}_21").alias("_new")
    ).distinct()
    return (
        df.join(mapping, col, "left")
        .withColumn(col, F.coalesce("_new", col))
        .select(*df.columns)
    )


def names_to_codes(df: DataFrame, name_col: str, lookup: DataFrame) -> DataFrame:
    """Replace an area-name column by lsoa_code; an unknown name gives null."""
    mapping = lookup.select(
        F.col("lsoa_name_21").alias(name_col), F.col("lsoa_code_21").alias("lsoa_code")
    ).distinct()
    return df.join(mapping, name_col, "left").drop(name_col)


def postcode_to_area(df: DataFrame, postcode_col: str, lookup: DataFrame) -> DataFrame:
    """Replace a postcode column by lsoa_code; an unknown postcode gives null, a repeated one fans out."""
    mapping = lookup.select(F.col("postcode").alias(postcode_col), "lsoa_code")
    return df.join(mapping, postcode_col, "left").drop(postcode_col)


def build_postcode_lookup(raw: DataFrame, districts: Sequence[str] | None = None) -> DataFrame:
    """Postcode table of the named districts; all districts keep theirs as a column."""
    out = {"postcode": "pcds", "lsoa_code": "lsoa21cd", "msoa_code": "msoa21cd"}
    columns: list[Column] = [F.col(src).alias(dst) for dst, src in out.items()]
    if districts is None:
        return raw.select(*columns, F.col("ladnm").alias("district"))
    return raw.filter(F.col("ladnm").isin(list(districts))).select(*columns)


def build_code_change_lookup(raw: DataFrame, district: str) -> DataFrame:
    """2011 to 2021 pairs of a district."""
    return raw.filter(F.col("LAD22NM") == district).select(
        F.col("LAD22CD").alias("local_authority_code"),
        F.col("LSOA21CD").alias("lsoa_code_21"),
        F.col("LSOA21NM").alias("lsoa_name_21"),
        F.col("LSOA11CD").alias("lsoa_code_11"),
        F.col("LSOA11NM").alias("lsoa_name_11"),
    )


def build_geography_lookup(raw: DataFrame) -> DataFrame:
    names = [
        "Geo Point", "Geo Shape", "LSOA Code", "Easting", "Northing", "Longitude", "Latitude",
        "Local Authority Code",
    ]
    return raw.select(*[F.col(n).alias(n.lower().replace(" ", "_")) for n in names])


def connectivity(raw: DataFrame, areas: DataFrame) -> DataFrame:
    """Transport scores pass through; only the key is renamed and districts are kept."""
    return attach_district(raw, "LSOA21CD", areas)
