"""Property price features per area.

Every statistic is written over *cells*: rows of (keys, price) with a count per kind
of sale. A single statistic uses one cell per sale (a projection, no extra shuffle);
the full feature set first merges cells by (keys, price), which is map-side combined,
spreads a hot area over all its prices, and feeds both the plain aggregates and the
exact order statistics from one scan.

For several snapshots the cells also carry a pane of time (`operators/panes.py`), and the statistics of
every window come from the moments and price counts of its panes.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from areastats.constants import PROPERTY_TYPES
from areastats.functions.numbers import share
from areastats.functions.parallel import shared
from areastats.functions.quantiles import nearest_rank, select_pane_ranks, select_ranks
from areastats.operators.panes import PANE, to_windows

KEYS = ("lsoa_code",)


def _counters(types: dict[str, str]) -> dict[str, Column]:
    counters = {"n": F.lit(True)}
    for code in types:
        counters[f"n_{code}"] = F.col("property_type") == code
    counters["n_new"] = F.col("old_new") == "Y"
    counters["n_old"] = F.col("old_new") == "N"
    counters["n_free"] = F.col("duration") == "F"
    return counters


def sale_cells(sales: DataFrame, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES) -> DataFrame:
    """One cell per sale."""
    flags = [F.coalesce(c.cast("long"), F.lit(0)).alias(name) for name, c in _counters(types).items()]
    return sales.select(*keys, F.col("price").cast("long").alias("price"), *flags)


def merge_cells(cells: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One cell per (keys, price); all statistics share its shuffle."""
    counters = [c for c in cells.columns if c not in (*keys, "price")]
    return shared(cells.groupBy(*keys, "price").agg(*[F.sum(c).alias(c) for c in counters]))


@dataclass(frozen=True)
class _Moments:
    """How count, sum of prices and count of priced sales of a counter, and the moments of all prices, are read from rows."""

    count: Callable[[str], Column]
    amount: Callable[[str], Column]
    priced: Callable[[str], Column]
    squares: Callable[[], Column]
    highest: Callable[[], Column]
    lowest: Callable[[], Column]


_BIG = "decimal(19,0)"
_OF_CELLS = _Moments(
    count=lambda c: F.sum(c),
    amount=lambda c: F.sum(F.col("price") * F.col(c)),
    priced=lambda c: F.sum(F.when(F.col("price").isNotNull(), F.col(c))),
    squares=lambda: F.sum((F.col("price") * F.col("n")).cast(_BIG) * F.col("price").cast(_BIG)).cast("decimal(38,0)"),
    highest=lambda: F.max("price"),
    lowest=lambda: F.min("price"),
)
_OF_PANES = _Moments(
    count=lambda c: F.sum(c),
    amount=lambda c: F.sum(f"{c}_amount"),
    priced=lambda c: F.sum(f"{c}_priced"),
    squares=lambda: F.sum("squares"),
    highest=lambda: F.max("highest"),
    lowest=lambda: F.min("lowest"),
)


def pane_moments(cells: DataFrame, keys: Sequence[str], types: dict[str, str] = PROPERTY_TYPES) -> DataFrame:
    """One row per (keys, pane) from which every statistic but the order statistics follows, for any run of panes."""
    m = _OF_CELLS
    sums = [f(c).alias(c + end) for c in _counters(types) for f, end in ((m.count, ""), (m.amount, "_amount"), (m.priced, "_priced"))]
    return cells.groupBy(*keys, PANE).agg(
        *sums, m.squares().alias("squares"), m.highest().alias("highest"), m.lowest().alias("lowest")
    )


def _mean(counter: str, m: _Moments) -> Column:
    return share(m.amount(counter), m.priced(counter))


def _sample_stdev(m: _Moments) -> Column:
    """Exact integer moments in decimal arithmetic, so equal prices give exactly 0."""
    total = m.amount("n").cast(_BIG)
    n = m.priced("n")
    spread = m.squares().cast("decimal(38,0)") - total * total / n.cast(_BIG)
    return F.when(n > 1, F.sqrt(spread.cast("double") / (n - 1)))


def _aggregates(types: dict[str, str], m: _Moments = _OF_CELLS) -> dict[str, Column]:
    n = m.count("n")
    out = {
        "lsoa_mean_price": _mean("n", m),
        "lsoa_stdev_price": _sample_stdev(m),
        "lsoa_max_price": m.highest(),
        "lsoa_min_price": m.lowest(),
        "lsoa_range_price": m.highest() - m.lowest(),
    }
    for code in types:
        out[f"{code}_mean_price"] = F.coalesce(_mean(f"n_{code}", m), F.lit(0.0))
    out["total_transactions"] = n
    for code in types:
        out[f"{code}_count_transactions"] = m.count(f"n_{code}")
    out["new_build_proportion"] = share(m.count("n_new"), n)
    out["freehold_proportion"] = share(m.count("n_free"), n)
    for code, name in types.items():
        out[f"{name}_proportion"] = share(m.count(f"n_{code}"), n)
    premium = F.coalesce(F.try_divide(_mean("n_new", m), _mean("n_old", m)), F.lit(0.0))
    out["new_build_price_premium"] = F.when(m.count("n_new") > 0, premium)
    return out


def _plain(sales: DataFrame, keys: Sequence[str], names: Sequence[str], types: dict[str, str] = PROPERTY_TYPES):
    wanted = _aggregates(types)
    return sale_cells(sales, keys, types).groupBy(*keys).agg(*[wanted[n].alias(n) for n in names])


_RANKS = {
    "_low": lambda n: F.floor((n - 1) / 2).cast("long"),
    "_high": lambda n: F.ceil((n - 1) / 2).cast("long"),
    "_p10": lambda n: nearest_rank(n, 0.1),
    "_p90": lambda n: nearest_rank(n, 0.9),
}


def _order_statistics(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _from_ranks(select_ranks(cells, keys, "price", "n", _RANKS), keys)


def _from_ranks(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    inequality = F.when(F.col("_p10") > 0, share(F.col("_p90"), F.col("_p10")))
    return ranked.select(
        *keys,
        ((F.col("_low") + F.col("_high")) / 2).alias("lsoa_median_price"),
        inequality.alias("lsoa_price_inequality"),
    )


def mean_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["lsoa_mean_price"])


def median_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    cells = merge_cells(sale_cells(sales, keys, {}), keys)
    ranked = _order_statistics(cells, keys).select(*keys, "lsoa_median_price")
    return cells.select(*keys).distinct().join(ranked, list(keys), "left")


def stdev_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sample standard deviation; one sale gives null."""
    return _plain(sales, keys, ["lsoa_stdev_price"])


def max_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["lsoa_max_price"])


def min_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["lsoa_min_price"])


def range_price(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["lsoa_range_price"])


def price_inequality(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Nearest-rank p90 / p10; null where p10 is not positive."""
    cells = merge_cells(sale_cells(sales, keys, {}), keys)
    ranked = _order_statistics(cells, keys).select(*keys, "lsoa_price_inequality")
    return cells.select(*keys).distinct().join(ranked, list(keys), "left")


def mean_price_by_type(sales: DataFrame, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES):
    return _plain(sales, keys, [f"{c}_mean_price" for c in types], types)


def transactions(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["total_transactions"])


def transactions_by_type(sales: DataFrame, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES):
    return _plain(sales, keys, [f"{c}_count_transactions" for c in types], types)


def new_build_share(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["new_build_proportion"])


def freehold_share(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return _plain(sales, keys, ["freehold_proportion"])


def type_share(sales: DataFrame, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES) -> DataFrame:
    return _plain(sales, keys, [f"{name}_proportion" for name in types.values()], types)


def new_build_premium(sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean new-build price / mean other price; only areas with a new build have a row."""
    out = _plain(sales.filter(F.col("old_new").isin("Y", "N")), keys, ["new_build_price_premium"])
    return out.filter(F.col("new_build_price_premium").isNotNull())


def price_features(
    sales: DataFrame, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES
) -> DataFrame:
    """All price statistics: one scan, one data-sized shuffle, one row per key."""
    cells = merge_cells(sale_cells(sales, keys, types), keys)
    plain = cells.groupBy(*keys).agg(*[c.alias(n) for n, c in _aggregates(types).items()])
    return _joined(plain, _order_statistics(cells, keys), keys, types)


def price_features_by_pane(
    cells: DataFrame, snapshots: Sequence[str], months: int, keys: Sequence[str] = KEYS, types: dict[str, str] = PROPERTY_TYPES
) -> DataFrame:
    """`price_features` of every snapshot's window, keyed by snapshot_date and `keys`, from cells with a pane.

    Several cells of one (keys, pane, price) are fine. Moments and bucket counts are made once per pane; windows
    add them up. Single prices are read only in the buckets that hold a wanted rank.
    """
    windowed = ["snapshot_date", *keys]
    moments = to_windows(pane_moments(cells, keys, types), snapshots, months)
    plain = moments.groupBy(*windowed).agg(*[c.alias(n) for n, c in _aggregates(types, _OF_PANES).items()])
    ranked = select_pane_ranks(cells, keys, "price", "n", _RANKS, PANE, lambda df: to_windows(df, snapshots, months), months)
    return _joined(plain, _from_ranks(ranked, windowed), windowed, types)


def _joined(plain: DataFrame, ranked: DataFrame, keys: Sequence[str], types: dict[str, str]) -> DataFrame:
    names = list(_aggregates(types))
    order = [*names[:1], "lsoa_median_price", *names[1:5], "lsoa_price_inequality", *names[5:]]
    return plain.join(ranked, list(keys), "left").select(*keys, *order)
