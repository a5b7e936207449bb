"""Population features per area from wide age-band tables whose columns differ by year."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from areastats.constants import POPULATION_BANDS, POPULATION_KEY
from areastats.functions.numbers import row_sum


def select_population_columns(raw: DataFrame, key: str = POPULATION_KEY) -> DataFrame:
    """Columns whose name holds 'to' or 'over' (case-sensitive), plus the key as lsoa_code."""
    bands = [F.col(f"`{c}`") for c in raw.columns if c != key and ("to" in c or "over" in c)]
    return raw.select(F.col(f"`{key}`").alias("lsoa_code"), *bands)


def _leading_number(text: str) -> tuple[str, str]:
    """The digits a text begins with, and the rest."""
    rest = text.lstrip("0123456789")
    return text[: len(text) - len(rest)], rest


def snake_header(name: str) -> str:
    """'0 - 4 years old population' -> 'aged_0_to_4'; '85 years old and over ...' -> 'aged_85_and_over'.

    An age header begins with a number. A dash and a second number, blanks or not, make a span; else the word
    "over" makes the oldest band. Other headers are only written in lower case with underscores.
    """
    low, rest = _leading_number(name)
    dash, _, after = rest.partition("-")
    high = "" if dash.strip() else _leading_number(after.lstrip())[0]
    if low and high:
        return f"aged_{low}_to_{high}"
    if low and "over" in rest:
        return f"aged_{low}_and_over"
    return name.lower().replace(" ", "_")


def snake_headers(raw: DataFrame, keep: Sequence[str] = (POPULATION_KEY,)) -> DataFrame:
    """Optional step: rename every age header, leaving the key columns alone."""
    return raw.withColumnsRenamed({c: snake_header(c) for c in raw.columns if c not in keep})


def population_features(
    people: DataFrame,
    keys: Sequence[str] = ("lsoa_code",),
    bands: dict[str, list[str]] = POPULATION_BANDS,
) -> DataFrame:
    """Row-wise sums over the band columns that exist, and their total."""
    present = set(people.columns)
    sums = {
        out: row_sum([F.col(f"`{c}`") for c in cols if c in present]) for out, cols in bands.items()
    }
    return people.select(
        *keys,
        row_sum(list(sums.values())).alias("lsoa_population"),
        *[c.alias(out) for out, c in sums.items()],
    )
