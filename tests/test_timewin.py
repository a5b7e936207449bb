"""Date windows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from areastats.functions import timewin
from areastats.sources.readers import file_years


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("snapshot,months,start,end", [
    ("2025-12-01", 12, date(2024, 12, 1), date(2025, 12, 1)),
    ("2025-06-01", 3, date(2025, 3, 1), date(2025, 6, 1)),
    ("2025-03-01", 6, date(2024, 9, 1), date(2025, 3, 1)),
    ("2025-06-01", 1, date(2025, 5, 1), date(2025, 6, 1)),
    ("2025-03-31", 1, date(2025, 2, 28), date(2025, 3, 31)),
])
def test_window_bounds(spark, snapshot, months, start, end):
    assert tuple(one(spark, timewin.window_bounds(snapshot, months))) == (start, end)


@pytest.mark.parametrize("snapshot,months,expected", [
    ("2025-12-01", 12, [f"2025-{m:02d}" for m in range(1, 13)]),
    ("2025-12-01", 3, ["2025-10", "2025-11", "2025-12"]),
    ("2025-03-01", 4, ["2024-12", "2025-01", "2025-02", "2025-03"]),
    ("2025-06-01", 1, ["2025-06"]),
])
def test_months_in_window(spark, snapshot, months, expected):
    assert one(spark, timewin.months_in_window(snapshot, months)) == expected


def test_months_ascend(spark):
    months = one(spark, timewin.months_in_window("2025-06-01", 6))
    assert months == sorted(months)


def test_bounds_and_months_differ_by_one_month_on_purpose(spark):
    start = one(spark, timewin.window_start("2025-12-01", 12))
    months = one(spark, timewin.months_in_window("2025-12-01", 12))
    assert start == date(2024, 12, 1) and months[0] == "2025-01" and months[-1] == "2025-12"


def test_month_strings_in_window_equal_the_list(spark):
    rows = spark.range(48).select(
        F.date_format(F.add_months(F.lit(date(2022, 1, 1)), F.col("id").cast("int")), "yyyy-MM").alias("month")
    )
    kept = rows.filter(timewin.month_in_window(F.col("month"), "2025-03-01", 14)).collect()
    assert sorted(r.month for r in kept) == one(spark, timewin.months_in_window("2025-03-01", 14))


def test_years_include_the_middle(spark):
    assert one(spark, timewin.years_in_window("2025-01-01", 24)) == [2023, 2024, 2025]
    assert file_years("2025-01-01", 24) == [2023, 2024, 2025]
    assert file_years("2025-12-01", 12) == [2024, 2025]
    assert file_years("2025-12-01", 11) == [2025]


def test_snapshot_dates_exclude_the_end(spark):
    dates = one(spark, timewin.snapshot_dates("2020-01-01", "2025-10-01"))
    assert len(dates) == 23 and dates[0] == date(2020, 1, 1) and dates[-1] == date(2025, 7, 1)


def test_default_snapshot_is_first_of_month(spark):
    got = one(spark, timewin.default_snapshot())
    today = one(spark, F.current_date())
    assert got == today.replace(day=1)


def test_claim_labels(spark):
    assert one(spark, timewin.month_of_claim_label(F.lit("december_2025"))) == "2025-12"


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp_ntz'2025-01-02 00:00:00' AS d, 1 AS x").write.parquet(path)
    kept = spark.read.parquet(path).filter(timewin.in_window(F.col("d"), "2025-12-01", 12))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d" in plan and "LessThanOrEqual(d" in plan
