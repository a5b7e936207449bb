"""Windows from panes, and features kept up to date from stored aggregates."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from areastats.operators import panes, prices, runs
from areastats.plans import features, states
from areastats.sources import readers

SNAPSHOTS = ["2024-01-01", "2024-02-29", "2024-03-31", "2024-03-31", "2024-07-15", "2025-06-30"]
SALE = "lsoa_code STRING, district STRING, price BIGINT, date_of_transfer TIMESTAMP_NTZ, property_type STRING, old_new STRING, duration STRING"


@pytest.fixture(scope="module")
def sales(spark):
    """Midnights, noons, window ends, null prices and dates, ties, and one area with most rows."""
    pick = random.Random(5)
    rows = []
    for i in range(600):
        moment = datetime(2022, 12, 1) + timedelta(days=pick.randrange(1000), hours=pick.choice([0, 0, 12]))
        if i % 40 == 0:
            moment = datetime.fromisoformat(pick.choice(SNAPSHOTS))
        price = None if i % 23 == 0 else pick.choice([1, 7, 250_000, pick.randrange(1, 10**6)])
        rows.append(("hot" if i % 3 else f"a{i % 5}", "d", price, None if i % 97 == 0 else moment, pick.choice("DSTFO"), pick.choice("YN"), pick.choice("FL")))
    return spark.createDataFrame(rows, SALE).cache()


def collected(df):
    cols = sorted(df.columns)
    # doubles come from sums in another order
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)


def direct(sales, snapshots, months):
    return prices.price_features(runs.attach_snapshots(sales, F.col("date_of_transfer"), snapshots, months), features.RUN_KEYS)


@pytest.mark.parametrize("months", [1, 12])
def test_windows_equal_copies_of_every_sale(sales, months):
    snapshots = sorted(set(SNAPSHOTS))
    paned = sales.withColumn("pane", panes.window_pane(F.col("date_of_transfer"), snapshots, months)).filter("pane is not null")
    keys = list(features.AREA_KEYS)
    cells = prices.merge_cells(prices.sale_cells(paned, [*keys, "pane"]), [*keys, "pane"])
    got = prices.price_features_by_pane(cells, snapshots, months, keys)
    assert collected(got) == collected(direct(sales, snapshots, months)) != []
    # cells of a pane need not be merged
    raw = prices.sale_cells(paned, [*keys, "pane"])
    assert collected(prices.price_features_by_pane(raw, snapshots, months, keys)) == collected(got)


def test_month_panes_serve_any_snapshot_on_a_cut_day(sales):
    keys = list(features.AREA_KEYS)
    cells = prices.sale_cells(sales.withColumn("pane", panes.month_pane(F.col("date_of_transfer"), (1, 15))), [*keys, "pane"])
    snapshots = ["2023-12-01", "2024-01-15", "2024-07-15"]
    got = prices.price_features_by_pane(cells, snapshots, 6, keys)
    assert collected(got) == collected(direct(sales, snapshots, 6)) != []


def test_cut_days_are_checked():
    panes.check_cut_days(["2024-03-01", "2024-04-15"], (1, 15))
    with pytest.raises(ValueError):
        panes.check_cut_days(["2024-03-02"], (1,))
    with pytest.raises(ValueError):
        panes.month_pane(F.lit(date(2024, 1, 1)), (31,))


LOOKUP = "lsoa_code_11 STRING, lsoa_name_11 STRING, lsoa_code_21 STRING, lsoa_name_21 STRING, lad_name STRING"
CRIMES = "lsoa_code STRING, district STRING, category STRING, outcome_status STRING, month STRING"
LISTS = {"categories": ["x", "y"], "outcomes": ["o"]}


def modified(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_late_rows_rewrite_only_what_they_touch(spark, tmp_path):
    lookup = spark.createDataFrame([("a", "A", "a", "A", "D1"), ("b", "B", "b", "B", "D2")], LOOKUP)
    source = states.crime_source(lookup, **LISTS)
    first = spark.createDataFrame([("a", "?", "x", "o", "2024-01"), ("b", "?", "y", None, "2024-05"), ("a", "?", "z", None, None)], CRIMES)
    late = spark.createDataFrame([("a", "?", "x", None, "2024-05"), ("b", "?", "x", "o", "2024-06")], CRIMES)
    snapshots, table, folder = ["2024-02-01", "2024-06-01", "2030-01-01"], str(tmp_path / "table"), str(tmp_path / "features")
    assert states.refresh(source, first, table, folder, snapshots, 3) == ["2024-02-01", "2024-06-01"]
    old = {f: t for f, t in modified(folder).items() if "2024-02-01" in f}
    assert states.refresh(source, late, table, folder, snapshots, 3) == ["2024-06-01"]
    assert old and old.items() <= modified(folder).items()
    got = readers.read_features(spark, folder, "crimes")
    want = features.crime_plan(first.unionByName(late), lookup, snapshots, 3, **LISTS)
    assert collected(got) == collected(want) != []
    # rows outside every window are kept for later snapshots and rewrite nothing
    before = modified(folder)
    assert states.refresh(source, late.withColumn("month", F.lit("2020-01")), table, folder, snapshots, 3) == []
    assert modified(folder) == before


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    lookup = spark.createDataFrame([("a", "A", "a", "A", "D1")], LOOKUP)
    source = states.claim_source(lookup)
    rows = spark.createDataFrame([("A", "2024-01", "g", 3), ("A", "january_2024", "g", 4)], "lsoa_name STRING, month STRING, condition_group STRING, value BIGINT")
    table = str(tmp_path / "table")
    schema = source.aggregates(rows).schema
    assert states.add_rows(source, rows, table, "s", 0)
    assert not states.add_rows(source, rows, table, "s", 0)
    assert states.add_rows(source, rows.limit(1), table, "s", 1)
    got = states.window_features(spark, source, table, schema, ["2024-01-01"], 2).collect()
    assert [(r.total_claims, r.mean_monthly_claims) for r in got] == [(10, 10.0)]


def test_empty_rows(spark, tmp_path, sales):
    postcodes = spark.createDataFrame([("p", "a")], "postcode STRING, lsoa_code STRING")
    lookup = spark.createDataFrame([("a", "A", "a", "A", "D1")], LOOKUP)
    source = states.sales_source(postcodes, lookup)
    none = sales.withColumn("postcode", F.lit("p")).drop("lsoa_code").limit(0)
    assert states.refresh(source, none, str(tmp_path / "t"), str(tmp_path / "f"), ["2024-01-01"]) == []
    one = sales.withColumn("postcode", F.lit("p")).drop("lsoa_code").filter("price is not null and date_of_transfer between '2023-02-01' and '2023-03-01'")
    assert states.refresh(source, one, str(tmp_path / "t"), str(tmp_path / "f"), ["2024-01-01"]) == ["2024-01-01"]
    row = readers.read_features(spark, str(tmp_path / "f"), "prices").collect()
    assert [r.total_transactions for r in row] == [one.count()]


def test_several_snapshots_read_sales_once(sales, spark):
    """Only aggregates by pane are copied to the snapshots."""
    postcodes = spark.createDataFrame([("p", "a")], "postcode STRING, lsoa_code STRING")
    lookup = spark.createDataFrame([("a", "A", "a", "A", "D1")], LOOKUP)
    raw = sales.withColumn("postcode", F.lit("p")).drop("lsoa_code")
    plan = features.price_plan(raw, postcodes, lookup, ["2024-01-01", "2024-04-01"])
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    copies = [i for i, line in enumerate(lines) if "Generate explode" in line and "snapshot_date" in line]
    assert copies
    for i in copies:
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        assert any(f"{panes.PANE}#" in line and "Aggregate [" in line for line in lines[i + 1 : end])
