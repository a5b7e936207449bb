"""Features on small hand-computed tables: nulls, single rows, zero denominators, fan-out."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from areastats.functions import timewin
from areastats.functions.quantiles import nearest_rank, ordered_bits, radix_ranks, select_ranks, value_bucket
from areastats.functions.text import district_slug
from areastats.operators import claims, combine, crime, geography, population, prices, runs
from areastats.plans import features
from areastats.sources import writers

SALES = "lsoa_code string, price long, property_type string, old_new string, duration string"


def by_key(df, key="lsoa_code"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("name,slug", [
    ("Bristol, City of", "bristol_city_of"),
    ("Bournemouth, Christchurch and Poole", "bournemouth_christchurch_and_poole"),
    (" Exeter ", "exeter"),
])
def test_district_slug(spark, name, slug):
    assert spark.range(1).select(district_slug(F.lit(name)).alias("s")).first().s == slug


def test_price_features_edge_cases(spark):
    rows = [
        ("one", 100, "T", "N", "F"),
        ("new", 10, "F", "Y", "L"), ("new", 30, "F", "Y", "L"),
        ("mix", 100, "T", "Y", "F"), ("mix", 50, "D", "N", "L"), ("mix", None, "D", "N", None),
        ("zero", 0, "O", "N", "F"), ("zero", 0, "O", "N", "F"),
        ("void", None, "S", "N", "F"),
    ]
    got = by_key(prices.price_features(spark.createDataFrame(rows, SALES)))
    assert got["one"]["lsoa_stdev_price"] is None and got["one"]["new_build_price_premium"] is None
    assert got["one"]["lsoa_price_inequality"] == 1.0
    assert got["new"]["new_build_price_premium"] == 0.0 and got["new"]["F_mean_price"] == 20.0
    assert got["new"]["lsoa_stdev_price"] == pytest.approx(math.sqrt(200)) and got["new"]["T_mean_price"] == 0.0
    assert got["mix"]["total_transactions"] == 3 and got["mix"]["lsoa_mean_price"] == 75.0
    assert got["mix"]["new_build_price_premium"] == 2.0 and got["mix"]["D_count_transactions"] == 2
    assert got["mix"]["freehold_proportion"] == pytest.approx(1 / 3)
    assert got["zero"]["lsoa_price_inequality"] is None and got["zero"]["lsoa_stdev_price"] == 0.0
    assert got["void"]["lsoa_median_price"] is None and got["void"]["total_transactions"] == 1


def test_single_statistics_agree_with_the_full_set(spark):
    rng = np.random.default_rng(5)
    rows = [
        (f"a{rng.integers(4)}", int(rng.integers(1, 10**6)), str(rng.choice(list("TFSDO"))), str(rng.choice(["Y", "N"])), str(rng.choice(["F", "L"])))
        for _ in range(500)
    ]
    sales = spark.createDataFrame(rows, SALES)
    full = by_key(prices.price_features(sales))
    singles = [
        prices.mean_price, prices.median_price, prices.stdev_price, prices.max_price, prices.min_price, prices.range_price,
        prices.price_inequality, prices.mean_price_by_type, prices.transactions, prices.transactions_by_type,
        prices.new_build_share, prices.freehold_share, prices.type_share, prices.new_build_premium,
    ]
    for fn in singles:
        for key, row in by_key(fn(sales)).items():
            for col, value in row.items():
                assert full[key][col] == pytest.approx(value) if col != "lsoa_code" else True, (fn.__name__, col)


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5, 6, 7, 8], [5], [-3.5, 0.0, 2.25, 2.25, 1e9, -1e-9], [7] * 50 + [8] * 50])
def test_nearest_rank(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    cells = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = select_ranks(cells, ["g"], "v", "n", {f"q{i}": (lambda n, q=q: nearest_rank(n, q)) for i, q in enumerate(qs)}).first()
    ordered = sorted(values)
    for i, q in enumerate(qs):
        assert got[f"q{i}"] == ordered[math.floor((len(values) - 1) * q + 0.5)]


def test_crime_features(spark):
    rows = [("a", "drugs", "Local resolution"), ("a", "drugs", None), ("a", "unknown", "Local resolution"), ("b", "unknown", None)]
    got = by_key(crime.crime_features(spark.createDataFrame(rows, "lsoa_code string, category string, outcome_status string")))
    assert got["a"]["drugs"] == 2 and got["a"]["total_crimes"] == 2 and got["a"]["Local resolution"] == 2
    assert got["a"]["resolution_rate"] == 1.0
    assert got["b"]["total_crimes"] == 0 and got["b"]["resolution_rate"] is None
    assert got["a"]["Investigation complete; no suspect identified"] == 0


def test_claim_features_weight_months_by_rows(spark):
    nwr, sfw = "universal_credit_no_work_required", "universal_credit_searching_for_work"
    rows = [("a", "m1", nwr, 10), ("a", "m1", sfw, 20), ("a", "m2", nwr, 40), ("b", "m1", nwr, None)]
    got = by_key(claims.claim_features(spark.createDataFrame(rows, "lsoa_code string, month string, condition_group string, value long")))
    assert got["a"]["total_claims"] == 70
    assert got["a"]["mean_monthly_claims"] == pytest.approx((30 + 30 + 40) / 3)
    assert got["a"]["mean_monthly_sfw_claims"] == pytest.approx((20 + 20 + 0) / 3)
    assert got["a"]["%_claims_nwr"] == pytest.approx(50 / 70)
    assert got["b"]["total_claims"] == 0 and got["b"]["%_claims_nwr"] is None


def test_population(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, None, 4, "x")], "`LSOA 2021 Code` string, `F0 to 15` long, `M16 to 29` long, `F65 and over` long, `M65 and over` long, Region string"
    )
    people = population.select_population_columns(df)
    assert "Region" not in people.columns
    row = population.population_features(people).first()
    assert (row.lsoa_population, row.aged_under_15, row.working_age_population, row.pension_age_population) == (7, 1, 2, 4)
    assert population.snake_header("0 - 4 years old population") == "aged_0_to_4"
    assert population.snake_header("85 years old and over population") == "aged_85_and_over"
    assert population.snake_header("Total Population") == "total_population"
    assert population.snake_header("0-4 years old") == population.snake_header("0 -4") == "aged_0_to_4"
    assert population.snake_header("85+ and over") == population.snake_header("85over") == "aged_85_and_over"
    assert population.snake_header("People 5 - 9") == "people_5_-_9"
    assert population.snake_header("5 of 9 - 12") == "5_of_9_-_12"
    assert population.snake_header("15 - 19 Years Old Population") == "aged_15_to_19"
    assert population.snake_header("Aged 90 And Over") == "aged_90_and_over"
    assert population.snake_header("Area Code 2021") == "area_code_2021"


def test_geography_fan_out_and_gaps(spark):
    lookup = spark.createDataFrame(
        [("o1", "n1", "N1", "D"), ("o2", "n2", "N2", "D"), ("o2", "n3", "N3", "D"), ("o4", "n1", "N1", "D"), ("o5", "n5", "N5", "E")],
        "lsoa_code_11 string, lsoa_code_21 string, lsoa_name_21 string, lad_name string",
    )
    rows = spark.createDataFrame([("o1",), ("o2",), ("n9",), (None,)], "code string")
    got = sorted(str(r.code) for r in geography.recode_2011_2021(rows, "code", lookup).collect())
    assert got == ["None", "n1", "n2", "n3", "n9"]
    named = spark.createDataFrame([("N1", 1), ("Total", 2)], "name string, v int")
    assert {r.v: r.lsoa_code for r in geography.names_to_codes(named, "name", lookup).collect()} == {1: "n1", 2: None}
    assert sorted(r.lsoa_code for r in geography.area_spine(lookup, "D").collect()) == ["n1", "n2", "n3"]
    assert geography.target_codes(lookup, "D").count() == 4
    codes = spark.createDataFrame([("n1",), ("n5",), (None,)], "c string")
    assert [r.lsoa_code for r in geography.filter_areas(codes, "c", "D", lookup).collect()] == ["n1"]
    posts = spark.createDataFrame([("p", "n1"), ("p", "n2")], "postcode string, lsoa_code string")
    assert geography.postcode_to_area(spark.createDataFrame([("p",), ("q",)], "pc string"), "pc", posts).count() == 3


def test_combine_checks(spark):
    spine = spark.createDataFrame([("a",), ("b",)], "lsoa_code string")
    good = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "lsoa_code string, x double")
    twice = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "lsoa_code string, y double")
    text = spark.createDataFrame([("a", "t")], "lsoa_code string, z string")
    assert by_key(combine.combine_checked(spine, good)) == {"a": {"lsoa_code": "a", "x": 1.0}, "b": {"lsoa_code": "b", "x": 0.0}}
    with pytest.raises(ValueError, match="row count"):
        combine.combine_checked(spine, twice)
    with pytest.raises(ValueError, match="nulls or NaN"):
        combine.combine_checked(spine, text)
    with pytest.raises(ValueError, match="more than one frame"):
        combine.combine(spine, good, good)
    doubled = spark.createDataFrame([("a",), ("a",)], "lsoa_code string")
    with pytest.raises(ValueError, match="duplicate"):
        combine.check_structure(doubled, doubled)
    unnamed = spark.createDataFrame([("a",), (None,)], "lsoa_code string")
    with pytest.raises(ValueError, match="null keys"):
        combine.check_structure(unnamed, unnamed)


def test_stitch_widens_types(spark):
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    b = spark.createDataFrame([("b", 2.5, 7)], "k string, v double, w long")
    assert sorted(tuple(r) for r in combine.stitch([a, b]).collect()) == [("a", 1.0, 0), ("b", 2.5, 7)]


def test_runs(spark):
    districts = spark.createDataFrame([("D",), ("E",)], "district string")
    planned = runs.plan_runs(["2024-01-01", "2024-04-01"], districts)
    assert planned.count() == 4
    done = planned.filter("district = 'D' AND snapshot_date = date'2024-01-01'")
    assert runs.pending_runs(planned, done).count() == 3
    sales = spark.sql("SELECT explode(array(timestamp_ntz'2023-03-31 00:00:00', timestamp_ntz'2023-04-01 00:00:00', timestamp_ntz'2024-04-01 00:00:00', timestamp_ntz'2024-04-01 00:00:01')) AS d")
    hits = runs.attach_snapshots(sales, F.col("d"), ["2024-01-01", "2024-04-01"], 12).groupBy("snapshot_date").count()
    assert {str(r.snapshot_date): r["count"] for r in hits.collect()} == {"2024-01-01": 2, "2024-04-01": 2}


def test_several_snapshots_equal_single_runs(spark):
    lookup = spark.createDataFrame([("o", "n1", "N1", "D"), ("o", "n2", "N2", "E")], "lsoa_code_11 string, lsoa_code_21 string, lsoa_name_21 string, lad_name string")
    crimes = spark.createDataFrame(
        [("n1", f"2024-{m:02d}", "drugs", None) for m in range(1, 13)] + [("n2", "2024-03", "drugs", None)],
        "lsoa_code string, month string, category string, outcome_status string",
    )
    both = features.crime_plan(crimes, lookup, ["2024-06-01", "2024-09-01"], 3).select(*features.RUN_KEYS, "drugs")
    single = [features.crime_plan(crimes, lookup, [s], 3).select(*features.RUN_KEYS, "drugs") for s in ("2024-06-01", "2024-09-01")]
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, single[0].union(single[1]).collect()))
    one = features.crime_plan(crimes, lookup, ["2024-04-01"], 2, ["E"]).collect()
    assert [(r.district, r.drugs) for r in one] == [("E", 1)]


def test_describe_splits_crowded_values_and_leaves_nan_out(spark):
    inf, nan = float("inf"), float("nan")
    crowded = [1 + i * 1e-9 for i in range(4001)]
    small = [i * 1e-7 for i in range(4001)]
    odd = [nan, inf, -inf, None, -2.0, 0.0, -0.5, 0.5, 2.0] + [None] * 3992
    df = spark.createDataFrame(list(zip(crowded, small, odd, strict=True)), "crowded double, small double, odd double")
    got = {r["column"]: r for r in combine.describe(df, keys=[]).collect()}
    for name, values in (("crowded", crowded), ("small", small)):
        assert [got[name][q] for q in ("25%", "50%", "75%")] == [values[1000], values[2000], values[3000]]
    row = got["odd"]
    assert (row["count"], row.null_count, row.nan_count, row.min, row.max) == (7, 3993, 1, -inf, inf)
    assert [row[q] for q in ("25%", "50%", "75%")] == [-0.5, 0.0, 2.0]
    buckets = df.select(value_bucket(F.col("crowded"), part=True).alias("p")).distinct().count()
    assert buckets > 10  # values of one bucket are cut further


def test_claim_months(spark):
    df = spark.createDataFrame([("2025-12",), ("december_2025",), (None,)], "m string")
    assert [r[0] for r in df.select(timewin.claim_month(F.col("m"))).collect()] == ["2025-12", "2025-12", None]
    with pytest.raises(Exception, match="not a month"):
        spark.createDataFrame([("Q4 2025",)], "m string").select(timewin.claim_month(F.col("m"))).collect()


def test_ordered_bits_follow_the_values(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.standard_normal(300) * 10.0 ** rng.integers(-300, 300, 300), [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.0, np.nextafter(1, 2), 1.7976931348623157e308, np.inf, -np.inf]])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("k")).collect()
    for r in rows:
        want = int(np.float64(abs(r.v)).view(np.int64))
        assert r.k == (-want if r.v < 0 else want), r.v


def test_radix_ranks_are_exact(spark):
    rng = np.random.default_rng(6)
    groups = {
        "wide": rng.standard_normal(999) * 10.0 ** rng.integers(-5, 5, 999), "crowded": 1 + rng.integers(0, 50, 700) * 2.0**-50, "one": np.array([3.5]),
        "same": np.full(40, -7.0), "whole": rng.integers(-20, 20, 500).astype(float), "ends": np.array([-np.inf, -1.0, 0.0, np.inf]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("wide", None), ("wide", float("nan")), ("none", None)]
    ranks = {f"q{int(100 * q)}": (lambda n, q=q: nearest_rank(n, q)) for q in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)}
    found = {r.g: r for r in radix_ranks(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", ranks).collect()}
    assert set(found) == set(groups)
    for g, vs in groups.items():
        for q in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0):
            assert found[g][f"q{int(100 * q)}"] == np.sort(vs)[int(np.floor((len(vs) - 1) * q + 0.5))], (g, q)


def _combined_setting(spark):
    spine = spark.createDataFrame([("a", "d"), ("b", "d"), ("c", "e")], "lsoa_code string, district string")
    values = spark.createDataFrame([("a", float("inf"), 1), ("b", float("nan"), None)], "lsoa_code string, x double, n int")
    return spine, values


def test_one_job_combines_fills_checks_and_writes(spark, tmp_path):
    spine, values = _combined_setting(spark)
    path = str(tmp_path / "t")
    made = combine.CheckedCombination(spine, values, keys=("lsoa_code", "district"))
    writers.write_verified(made.rows, path, ["district"], made.verify)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("lsoa_code", "x", "n", "district").collect())
    assert got == [("a", 0.0, 1, "d"), ("b", 0.0, 0, "d"), ("c", 0.0, 0, "e")]
    plain = combine.quality_report(combine.combine(spine, values, keys=("lsoa_code", "district")), ("lsoa_code", "district"))
    assert sorted(made.report()) == sorted(map(tuple, plain.collect()))
    assert [n for n in os.listdir(path) if n.startswith("_draft")] == []


@pytest.mark.parametrize("fault", ["rows", "spine", "key", "text"])
def test_a_failed_check_keeps_the_old_partitions(spark, tmp_path, fault):
    spine, values = _combined_setting(spark)
    path = str(tmp_path / "t")
    old = combine.CheckedCombination(spine, values, keys=("lsoa_code", "district"))
    writers.write_verified(old.rows, path, ["district"], old.verify)
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    message = {"rows": "row count mismatch", "spine": "duplicate keys", "key": "null keys", "text": "remain after fill"}[fault]
    if fault == "rows":
        values = values.unionAll(values.filter("lsoa_code = 'a'"))
    if fault == "spine":
        spine = spine.unionAll(spine.limit(1))
        message = "row count mismatch|duplicate keys"
    if fault == "key":
        spine = spine.unionAll(spark.createDataFrame([(None, "d")], spine.schema))
    if fault == "text":
        values = values.withColumn("note", F.lit("x"))
    made = combine.CheckedCombination(spine, values, keys=("lsoa_code", "district"))
    with pytest.raises(ValueError, match=message):
        writers.write_verified(made.rows, path, ["district"], made.verify)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
    assert [n for n in os.listdir(path) if n.startswith("_draft")] == []


def test_describe_never_broadcasts_raw_rows(spark):
    df = spark.range(2000).select((F.col("id") / 7).alias("a"), F.col("id").alias("b"))  # estimated far below the broadcast threshold
    plan = combine.describe(df, keys=[])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "_prefix" in line and "Join " in line]
    assert joins and all("BroadcastHashJoin" in line and "BuildRight" in line for line in joins)
