"""Numeric expressions shared by the feature operators."""

from functools import reduce

from pyspark.sql import Column, functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; a zero denominator gives null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def row_sum(columns: list[Column], zero=0) -> Column:
    """Null-ignoring sum across columns."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(zero)) for c in columns], F.lit(zero))


def is_inf(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))
