"""Exact order statistics without gathering a group in one task.

A group (an area) may hold a third of all rows, so its values are never sorted or
collected together. Values are first counted per (group, value). Counts per
(group, bucket) locate the bucket that holds each wanted rank, and only the
distinct values of that bucket are ranked. A bucket is 1/256 of a power of two wide, so a group
has some thousands of them however many rows it holds. Values other than whole numbers
may crowd within one bucket; `refine` cuts located buckets into 65,536 parts once more.
NaN has no rank; infinities come first and last.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from areastats.functions.kernels import ordered_bits

BUCKETS_PER_OCTAVE = 256


def nearest_rank(n: Column, q: float) -> Column:
    """0-based rank of the nearest-rank quantile of n sorted values."""
    return F.floor((n - 1) * F.lit(q) + F.lit(0.5)).cast("long")


def _split(value: Column) -> tuple[Column, Column]:
    """Exponent and mantissa - 1 of a positive finite double, exact for either rounding of log2."""
    guess = F.floor(F.log2(value))
    low = F.when(F.pow(F.lit(2.0), guess) > value, guess - 1).otherwise(guess)
    exponent = F.when(F.pow(F.lit(2.0), low + 1) <= value, low + 1).otherwise(low)
    return exponent, value / F.pow(F.lit(2.0), exponent) - 1.0


def value_bucket(value: Column, part: bool = False) -> Column:
    """Monotone in `value`, relative width 1/256; with `part`, the part within that bucket (0 to 65,535).

    Values below 2**-1000 share the bucket of zero.
    """
    v = value.cast("double")
    size = F.abs(v)
    exponent, mantissa = _split(F.when((size >= 2.0**-1000) & (size < float("inf")), size))
    steps = mantissa * BUCKETS_PER_OCTAVE
    if part:
        within = F.floor((steps - F.floor(steps)) * 65_536)
        return F.coalesce((F.signum(v) * within).cast("long"), F.lit(0).cast("long"))
    bucket = (exponent + 1001) * BUCKETS_PER_OCTAVE + F.floor(steps)
    whole = F.when(size == float("inf"), F.lit(10**9)).otherwise(F.coalesce(bucket, F.lit(0)))
    return (F.signum(v) * whole).cast("long")


def radix_ranks(
    rows: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Callable[[Column], Column]], bits: int = 16
) -> DataFrame:
    """One row per group with the value at each wanted rank, from raw rows in 64 / `bits` passes.

    Each pass counts the rows that share the prefix located before, by the next `bits` bits of
    the value. Counts combine map-side, so a task hands on at most 2^bits rows a group and rank,
    whatever the number of rows or of distinct values; nothing is sorted but counts. The prefixes, a
    row per group and rank, are what is broadcast: planned by size estimates, exploded raw rows would be.
    Groups are therefore few, as the columns of a table are. NaN and null have no rank, a group without
    other values has no row.
    """
    keys = list(keys)
    double = F.col(value).cast("double")
    base = rows.filter(double.isNotNull() & ~F.isnan(double)).select(*keys, F.col(value).alias("_v"), ordered_bits(double).alias("_bits"))
    wanted = _wanted(ranks)
    group = Window.partitionBy(*keys)
    prefix = lambda used: F.shiftright("_bits", 64 - used)
    first = base.groupBy(*keys, prefix(bits).alias("_prefix")).agg(F.count("*").alias("_n"), F.min("_v").alias("_v"))
    found = _located(first.withColumn("_size", F.sum("_n").over(group)), group.orderBy("_prefix"), wanted, F.col("_want.rank"))
    found = found.select(*keys, F.col("_want.name").alias("_name"), "_prefix", "_offset", "_v")
    for used in range(2 * bits, 64 + bits, bits):
        place = [*keys, "_name"]
        inside = base.withColumn("_prefix", prefix(used - bits)).join(F.broadcast(found.drop("_v")), [*keys, "_prefix"])
        counted = inside.groupBy(*place, prefix(min(used, 64)).alias("_next")).agg(
            F.count("*").alias("_n"), F.min("_v").alias("_v"), F.first("_offset").alias("_before")
        )
        found = _located(counted, Window.partitionBy(*place).orderBy("_next"), F.lit(0), F.col("_before")).select(
            *place, F.col("_next").alias("_prefix"), "_offset", "_v"
        )
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])


def select_ranks(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    ranks: dict[str, Callable[[Column], Column]],
    refine: bool = False,
) -> DataFrame:
    """One row per group with the value at each wanted rank.

    `cells` holds one row per (keys, value) with its count in `weight`; `ranks`
    names a column for each function from the group's size to a 0-based rank.
    """
    keys = list(keys)
    bucketed = _bucketed(cells, keys, value, weight)
    group = Window.partitionBy(*keys)
    located = _located(
        bucketed.groupBy(*keys, "_bucket").agg(F.sum("_w").alias("_n")).withColumn("_size", F.sum("_n").over(group)),
        group.orderBy("_bucket"), _wanted(ranks), F.col("_want.rank"),
    ).select(*keys, "_bucket", F.col("_want.name").alias("_name"), "_offset")
    inside = bucketed.join(located, [*keys, "_bucket"])
    place = [*keys, "_bucket", "_name"]
    if refine:
        parted = inside.withColumn("_part", value_bucket(F.col(value), part=True))
        narrowed = _located(
            parted.groupBy(*place, "_part").agg(F.sum("_w").alias("_n"), F.first("_offset").alias("_before")),
            Window.partitionBy(*place).orderBy("_part"), F.lit(0), F.col("_before"),
        ).select(*place, "_part", F.col("_offset").alias("_rest"))
        inside = parted.join(narrowed, [*place, "_part"]).drop("_offset").withColumnRenamed("_rest", "_offset")
    return _hits(inside, keys, value, ranks)


def select_pane_ranks(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    ranks: dict[str, Callable[[Column], Column]],
    pane: str,
    to_windows: Callable[[DataFrame], DataFrame],
    months: int,
) -> DataFrame:
    """`select_ranks` for every (snapshot_date, keys) from cells with a pane of time.

    `to_windows` copies rows with a pane to the snapshots whose window holds it. Only bucket counts are copied;
    cells meet the snapshots that look for a rank in their bucket.
    """
    keys = list(keys)
    bucketed = _bucketed(cells, [*keys, pane], value, weight)
    windowed = ["snapshot_date", *keys]
    counts = to_windows(bucketed.groupBy(*keys, pane, "_bucket").agg(F.sum("_w").alias("_n")))
    group = Window.partitionBy(*windowed)
    located = _located(
        counts.groupBy(*windowed, "_bucket").agg(F.sum("_n").alias("_n")).withColumn("_size", F.sum("_n").over(group)),
        group.orderBy("_bucket"), _wanted(ranks), F.col("_want.rank"),
    ).select(*windowed, "_bucket", F.col("_want.name").alias("_name"), "_offset")
    held = F.col(pane).between(F.add_months("snapshot_date", -months), F.col("snapshot_date"))
    return _hits(bucketed.join(located, [*keys, "_bucket"]).filter(held), windowed, value, ranks)


def _bucketed(cells: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    ranked = F.col(value).isNotNull() & (F.col(weight) > 0) & ~F.isnan(F.col(value).cast("double"))
    rows = cells.filter(ranked).select(*keys, F.col(value), F.col(weight).alias("_w"))
    return rows.withColumn("_bucket", value_bucket(F.col(value)))


def _wanted(ranks: dict[str, Callable[[Column], Column]]) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), rank(F.col("_size")).alias("rank")) for name, rank in ranks.items()
    ]))


def _hits(inside: DataFrame, keys: Sequence[str], value: str, ranks: dict) -> DataFrame:
    """The value at each wanted rank among the rows of its bucket."""
    in_bucket = Window.partitionBy(*keys, "_bucket", "_name").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hits = inside.withColumn("_seen", F.sum("_w").over(in_bucket)).filter(
        (F.col("_offset") < F.col("_seen")) & (F.col("_offset") >= F.col("_seen") - F.col("_w"))
    )
    return hits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in ranks]
    )


def _located(counted: DataFrame, order, want: Column, rank: Column) -> DataFrame:
    """The rows (buckets with a count _n, in order) that hold a rank, with the rank's _offset in them."""
    upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        counted.withColumn("_upto", upto)
        .withColumn("_want", want)
        .withColumn("_offset", rank - (F.col("_upto") - F.col("_n")))
        .filter((F.col("_offset") >= 0) & (F.col("_offset") < F.col("_n")))
    )
