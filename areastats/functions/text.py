"""String expressions."""

from pyspark.sql import Column, functions as F


def district_slug(name: Column) -> Column:
    """File-system safe district name: 'Bristol, City of' -> 'bristol_city_of'."""
    underscored = F.lower(F.replace(name, F.lit(" "), F.lit("_")))
    return F.replace(F.btrim(underscored, F.lit("_")), F.lit(","), F.lit(""))


def relabel(value: Column, labels: dict[str, str]) -> Column:
    """Map known labels; leave every other value (and null) as it is."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[value], value)
