"""Join feature frames on the area spine, check, report, fill, stack."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from areastats.functions.numbers import is_inf
from areastats.functions.quantiles import nearest_rank, radix_ranks

KEYS = ("lsoa_code",)


def _q(name: str):
    return F.col(f"`{name}`")


def _is_float(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def _numeric(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys
    ]


def combine(spine: DataFrame, *frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Left-join every frame on the spine. Frames must be unique per key and not share columns.

    A frame may lack some keys (population has no snapshot): it is joined on those it has.
    """
    seen = set(spine.columns)
    out = spine
    for frame in frames:
        shared = [k for k in keys if k in frame.columns]
        clash = seen & (set(frame.columns) - set(keys))
        if clash or not shared:
            raise ValueError(f"no key, or columns in more than one frame: {sorted(clash)}")
        seen |= set(frame.columns)
        out = out.join(frame, shared, "left")
    return out


def structure_report(combined: DataFrame, spine: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: expected_rows, n_rows, duplicate_rows, null_keys.

    Keys are counted before they are compared, so a repeated key costs one map-side
    combined row per task.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tagged = spine.select(*keys, F.lit(1).alias("_spine"), F.lit(0).alias("_row")).unionAll(
        combined.select(*keys, F.lit(0), F.lit(1))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("_spine").alias("_spine"), F.sum("_row").alias("_n"))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total(F.col("_spine")).alias("expected_rows"),
        total(F.col("_n")).alias("n_rows"),
        total(F.greatest(F.col("_n") - 1, F.lit(0))).alias("duplicate_rows"),
        total(F.when(no_key, F.col("_n"))).alias("null_keys"),
    )


def check_structure(combined: DataFrame, spine: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Raise when rows were lost, repeated or have no key; otherwise return the frame."""
    r = structure_report(combined, spine, keys).first()
    if r.n_rows != r.expected_rows:
        raise ValueError(f"row count mismatch: expected {r.expected_rows} from the spine, got {r.n_rows}")
    if r.duplicate_rows:
        raise ValueError(f"duplicate keys: {r.duplicate_rows} rows")
    if r.null_keys:
        raise ValueError(f"null keys: {r.null_keys} rows")
    return combined


def quality_report(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per value column: inf_count, nan_count, null_count."""
    never = F.lit(False)
    flags = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"),
            (F.coalesce(is_inf(_q(f.name)), never) if _is_float(f) else never).alias("inf"),
            (F.coalesce(F.isnan(_q(f.name)), never) if _is_float(f) else never).alias("nan"),
            _q(f.name).isNull().alias("null"),
        )
        for f in df.schema.fields
        if f.name not in keys
    ])
    return (
        df.select(F.inline(flags))
        .groupBy("column")
        .agg(
            F.count_if("inf").alias("inf_count"),
            F.count_if("nan").alias("nan_count"),
            F.count_if("null").alias("null_count"),
        )
    )


def fill(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Infinite -> null, then NaN and null -> 0, in numeric columns."""

    def filled(f: T.StructField):
        if f.name in keys or not isinstance(f.dataType, T.NumericType):
            return _q(f.name)
        zero = F.lit(0).cast(f.dataType)
        value = _q(f.name)
        if _is_float(f):
            value = F.when(~(is_inf(value) | F.isnan(value)), value)
        return F.coalesce(value, zero).alias(f.name)

    return df.select(*[filled(f) for f in df.schema.fields])


def check_filled(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Raise when a column still holds null (a text column can) or NaN."""
    left = quality_report(df, keys).filter("null_count > 0 OR nan_count > 0").collect()
    if left:
        raise ValueError(f"nulls or NaN remain after fill: { {r['column']: r['null_count'] + r['nan_count'] for r in left} }")
    return df


def combine_checked(spine: DataFrame, *frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """combine, structural checks, fill and the final check: the table that is written."""
    combined = check_structure(combine(spine, *frames, keys=keys), spine, keys)
    return check_filled(fill(combined, keys), keys)


class CheckedCombination:
    """combine and fill as one plan that counts, while it runs, all that `combine_checked` asks for.

    `rows` is the filled table. After one action on it, `verify` raises the same errors, and
    `report` has the counts of infinite, NaN and null values by column from before the fill.
    """

    def __init__(self, spine: DataFrame, *frames: DataFrame, keys: Sequence[str] = KEYS):
        self.keys, self._spine, self._joined, self._filled = list(keys), Observation(), Observation(), Observation()
        counted = spine.groupBy(*keys).agg(F.count("*").alias("_times"))
        counted = counted.observe(self._spine, F.count("*").alias("distinct"), F.coalesce(F.sum("_times"), F.lit(0)).alias("rows"))
        joined = combine(counted.drop("_times"), *frames, keys=keys)
        self.columns = [f.name for f in joined.schema.fields if f.name not in keys]
        floats = {f.name for f in joined.schema.fields if _is_float(f)}
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        tests = {"inf": lambda c: is_inf(_q(c)), "nan": lambda c: F.isnan(_q(c)), "null": lambda c: _q(c).isNull()}
        before = [F.count_if(t(c)).alias(f"{k}_{i}") for i, c in enumerate(self.columns) for k, t in tests.items() if k == "null" or c in floats]
        joined = joined.observe(self._joined, F.count("*").alias("rows"), F.count_if(no_key).alias("null_keys"), *before)
        left = [
            F.count_if(_q(c).isNull() | F.isnan(_q(c)) if c in floats else _q(c).isNull()).alias(f"left_{i}") for i, c in enumerate(self.columns)
        ]
        self.rows = fill(joined, keys).observe(self._filled, F.count("*").alias("rows"), *left)

    def report(self) -> list[tuple[str, int, int, int]]:
        """(column, inf_count, nan_count, null_count) as in `quality_report`."""
        got = self._joined.get
        return [(c, *(got.get(f"{k}_{i}", 0) for k in ("inf", "nan", "null"))) for i, c in enumerate(self.columns)]

    def verify(self) -> None:
        spine, joined, filled = self._spine.get, self._joined.get, self._filled.get
        if joined["rows"] != spine["rows"]:
            raise ValueError(f"row count mismatch: expected {spine['rows']} from the spine, got {joined['rows']}")
        if spine["rows"] != spine["distinct"]:
            raise ValueError(f"duplicate keys: {spine['rows'] - spine['distinct']} rows")
        if joined["null_keys"]:
            raise ValueError(f"null keys: {joined['null_keys']} rows")
        left = {c: n for i, c in enumerate(self.columns) if (n := filled[f"left_{i}"])}
        if left:
            raise ValueError(f"nulls or NaN remain after fill: {left}")


def stitch(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames with differing columns; types widen, missing numeric values become 0."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.fillna(0)


def describe(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per numeric column: count, null_count, nan_count, mean, std, min, exact nearest-rank quartiles, max.

    NaN is counted apart and is part of no statistic; infinities are values. No distinct value is
    shuffled: moments and histograms of value prefixes combine map-side.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), _q(c).cast("double").alias("value")) for c in _numeric(df, keys)
    ])
    cells = df.select(F.inline(pairs))
    nan = F.coalesce(F.isnan("value"), F.lit(False))
    value = F.when(~nan, F.col("value"))
    basic = cells.groupBy("column").agg(
        F.count(value).alias("count"), F.count_if(F.col("value").isNull()).alias("null_count"), F.count_if(nan).alias("nan_count"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )
    quartiles = radix_ranks(cells, ["column"], "value", {
        "25%": lambda n: nearest_rank(n, 0.25),
        "50%": lambda n: nearest_rank(n, 0.5),
        "75%": lambda n: nearest_rank(n, 0.75),
    })
    return (
        basic.join(quartiles, "column", "left")
        .select("column", "count", "null_count", "nan_count", "mean", "std", "min", "`25%`", "`50%`", "`75%`", "max")
    )


def describe_text(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per text column: count, null_count, min and max in code point order."""
    names = [c for c, kind in df.dtypes if kind == "string" and c not in keys]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _q(c).alias("value")) for c in names])
    if not names:
        pairs = pairs.cast("array<struct<column:string,value:string>>")
    return df.select(F.inline(pairs)).groupBy("column").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("null_count"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
