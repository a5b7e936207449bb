"""Readers, sinks, landing stream: real files in a temporary folder."""

import json

import pytest
from pyspark.sql import functions as F

from areastats.operators.geography import districts_areas
from areastats.plans import pipeline
from areastats.sources import crime_feed, cube, inventory, map_elements, readers, writers
from areastats.sources.schemas import CRIME_SCHEMA
from areastats.streaming import landing


def test_price_files_are_chosen_by_year(spark, tmp_path):
    row = '"{{{id}}}","{price}","{day} 00:00","BS1 1AA","T","N","F","1","","HIGH ST","","BRISTOL","BRISTOL","AVON","A","A"'
    for year in (2023, 2024, 2025):
        days = [f"{year}-01-15", f"{year}-12-01"]
        (tmp_path / f"land_registry_price_paid_{year}.csv").write_text("\n".join(row.format(id=d, price=100000, day=d) for d in days))
    every = readers.read_prices(spark, str(tmp_path))
    assert every.count() == 6 and dict(every.dtypes)["price"] == "bigint"
    window = readers.read_prices(spark, str(tmp_path), "2025-12-01", 12)
    assert sorted(str(r.date_of_transfer.date()) for r in window.collect()) == ["2024-12-01", "2025-01-15", "2025-12-01"]
    assert len(window.inputFiles()) == 2
    middle = readers.read_prices(spark, str(tmp_path), "2025-06-01", 30)
    assert middle.count() == 5 and len(middle.inputFiles()) == 3


def test_crime_months_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "crime")
    rows = [("a", "drugs", None, f"2025-{m:02d}") for m in range(1, 13)]
    writers.write_months(spark.createDataFrame(rows, CRIME_SCHEMA), path)
    window = readers.read_crime(spark, path, "2025-06-01", 3)
    assert sorted(r.month for r in window.collect()) == ["2025-04", "2025-05", "2025-06"]
    assert "PartitionFilters: [isnotnull(month" in window._jdf.queryExecution().executedPlan().toString()
    writers.write_months(spark.createDataFrame([("b", "drugs", None, "2025-06")], CRIME_SCHEMA), path)
    again = readers.read_crime(spark, path)
    assert again.count() == 12 and again.filter("lsoa_code = 'b'").count() == 1


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame(
        [("o1", "n1", "N1", "D"), ("o2", "n2", "N2", "D"), ("o2", "n3", "N3", "D"), ("x", "n9", "N9", "E")],
        "lsoa_code_11 string, lsoa_code_21 string, lsoa_name_21 string, lad_name string",
    )


def test_bulk_crime_files(spark, tmp_path, lookup):
    folder = tmp_path / "2025-01"
    folder.mkdir()
    (folder / "2025-01-avon-street.csv").write_text(
        "Crime ID,Month,LSOA code,Crime type\nc1,2025-01,o1,Drugs\nc2,2025-01,o2,Burglary\n,2025-01,o1,Anti-social behaviour\nc3,2025-01,n9,Drugs\nc4,2025-01,n1,Mystery\n"
    )
    (folder / "2025-01-avon-outcomes.csv").write_text(
        "Crime ID,Month,Outcome type\nc1,2025-01,Local resolution\nc1,2025-01,Under investigation\n,2025-01,Local resolution\n"
    )
    street = readers.read_bulk_csv(spark, str(tmp_path), "street")
    outcomes = readers.read_bulk_csv(spark, str(tmp_path), "outcomes")
    areas = districts_areas(lookup, ["D"])
    got = sorted(tuple(r) for r in crime_feed.merge_bulk_crime(street, outcomes, lookup, areas).fillna("-").collect())
    assert got == [
        ("2025-01", "D", "Mystery", "n1", "-"),
        ("2025-01", "D", "burglary", "n2", "-"), ("2025-01", "D", "burglary", "n3", "-"),
        ("2025-01", "D", "drugs", "n1", "Local resolution"), ("2025-01", "D", "drugs", "n1", "Under investigation"),
    ]
    without = crime_feed.merge_bulk_crime(street, None, lookup, areas)
    assert without.count() == 4 and without.filter("outcome_status IS NOT NULL").count() == 0


def test_api_crimes(spark):
    texts = ['{"category":"drugs","outcome_status":null}', '{"category":"drugs","outcome_status":{"category":"Under investigation"}}', '{"category":"other"}']
    df = spark.createDataFrame([("a", "2025-01", t) for t in texts], "lsoa_code string, month string, body string")
    assert [r.outcome_status for r in crime_feed.normalise_api_crimes(df, F.col("body")).collect()] == [None, "Under investigation", None]


def test_cube_response(spark):
    doc = {
        "fields": [
            {"label": "National - Regional - LA - OAs", "items": [{"labels": ["N1"]}, {"labels": ["N2"]}, {"labels": ["Total"]}]},
            {"label": "Month", "items": [{"labels": ["December 2025"]}, {"labels": ["January 2026"]}]},
            {"label": "Other", "items": [{"labels": ["x"]}]},
        ],
        "cubes": {"count": {"values": [[[5.0], 6], [[0], [7.5, 1]], [[5], None]]}},
    }
    df = spark.createDataFrame([("g", json.dumps(doc))], "condition_group string, payload string")
    got = {(r.lsoa_name, r.month): r.value for r in cube.flatten_cubes(df, F.col("payload")).collect()}
    assert got == {
        ("N1", "december_2025"): 5.0, ("N1", "january_2026"): 6.0, ("N2", "december_2025"): 0.0, ("N2", "january_2026"): 7.5,
        ("Total", "december_2025"): 5.0, ("Total", "january_2026"): None,
    }


def test_map_files(spark, tmp_path):
    node = {"type": "node", "id": 1, "lat": 51.0, "lon": -2.5, "tags": {"amenity": "pub"}}
    way = {"type": "way", "id": 2, "bounds": {"minlat": 1}, "nodes": [1, 2], "geometry": [{"lat": 51.0, "lon": -2.5}] * 4}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps({"version": 0.6, "elements": [node, way]}, indent=2))
    (tmp_path / "lines.json").write_text(json.dumps(node) + "\n" + json.dumps(way) + "\n")
    for df in (map_elements.read_map_responses(spark, str(tmp_path / "docs")), map_elements.read_map_element_lines(spark, str(tmp_path / "lines.json"))):
        rows = {r.id: r for r in df.collect()}
        assert rows[1].tags == {"amenity": "pub"} and len(rows[2].geometry) == 4 and rows[2].tags is None


def test_lookup_csv_and_inventory(spark, tmp_path, lookup):
    path = str(tmp_path / "lookup")
    writers.write_lookup_csv(lookup, path)
    back = readers.read_area_lookup(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lookup.select(back.columns).collect()))
    files = inventory.file_inventory(spark.read.option("header", True).csv(path), "lookup")
    one = inventory.source_inventory(files).first()
    assert one.n_rows == 4 and one.n_files == files.count() and one.newest_file is not None


def test_land_months_only_takes_new_files(spark, tmp_path):
    inbox, table, mark = (str(tmp_path / n) for n in ("inbox", "table", "mark"))
    schema = "lsoa_code STRING, category STRING, outcome_status STRING, month STRING"

    def arrive(month, code):
        spark.createDataFrame([(code, "drugs", None, month)], schema).write.mode("append").parquet(inbox)

    def land(rows=None):
        rows = landing.stream_files(spark, inbox, schema) if rows is None else rows
        landing.land_months(rows, table, mark).awaitTermination()
        return sorted((r.month, r.lsoa_code) for r in readers.read_crime(spark, table).collect())

    arrive("2025-01", "a")
    assert land() == [("2025-01", "a")]
    assert land() == [("2025-01", "a")]  # nothing new
    arrive("2025-02", "b")
    assert land() == [("2025-01", "a"), ("2025-02", "b")]
    arrive("2025-02", "late")
    arrive("2025-03", "c")
    stored = spark.createDataFrame([("2025-03", "c"), ("2025-02", "b")], "month string, lsoa_code string")
    rows = landing.without_stored(landing.stream_files(spark, inbox, schema), stored, ["month", "lsoa_code"])
    assert land(rows) == [("2025-01", "a"), ("2025-02", "b"), ("2025-02", "late")]


def test_near_boxes(spark):
    rows = [
        ("node", 1, 0.5, 50.5, None), ("node", 2, 3.0, 50.5, None), ("way", 3, None, None, [(9.0, 9.0), (0.1, 50.1)]),
        ("way", 4, None, None, [(9.0, 9.0)]), ("node", 5, None, None, None), ("way", 6, None, None, None),
    ]
    elements = spark.createDataFrame(rows, "type string, id long, lon double, lat double, geometry array<struct<lon:double,lat:double>>")
    boxes = spark.createDataFrame([("d", 50.0, 0.0, 51.0, 1.0)], "district string, min_lat double, min_lon double, max_lat double, max_lon double")
    assert sorted(r.id for r in map_elements.near_boxes(elements, boxes).collect()) == [1, 3]
    assert map_elements.near_boxes(elements, boxes.limit(0)).count() == 0


def test_boxes_lose_nothing_that_counts(spark, monkeypatch):
    rows = [
        ("node", 1, 0.5, 50.5, None), ("node", 2, 1.06, 50.5, None), ("node", 3, 9.0, 55.0, None),  # inside, in a buffer, far
        ("way", 4, None, None, [(-1.0, 50.5), (2.0, 50.5)]),  # crosses
        ("way", 5, None, None, [(-1.0, 49.0), (2.0, 49.0), (2.0, 52.0), (-1.0, 52.0), (-1.0, 49.0)]),  # encloses
        ("way", 6, None, None, [(1.06, 50.5), (1.06, 50.6)]), ("way", 7, None, None, [(3.0, 50.5), (3.0, 50.6)]),  # in a buffer, beyond
    ]
    elements = spark.createDataFrame(rows, "type string, id long, lon double, lat double, geometry array<struct<lon:double,lat:double>>")
    boxes = spark.createDataFrame([("d", 50.0, 0.0, 51.0, 1.0)], "district string, min_lat double, min_lon double, max_lat double, max_lon double")
    lookup = spark.createDataFrame([("E1", "d 1", "d")], "lsoa_code string, lsoa_name string, district string")
    boundaries = spark.createDataFrame([("E1", "d")], "lsoa_code string, district string")
    monkeypatch.setattr(pipeline, "districts_areas", lambda *_: lookup.select("lsoa_code", "district"))
    monkeypatch.setattr(pipeline, "_map_frame", lambda shapes, elements, types: elements)
    raw = pipeline.Inputs(lookup=lookup, boundaries=boundaries, elements=elements, boxes=boxes)
    assert sorted(r.id for r in pipeline.feature_frames(raw, ["2025-12-01"])["map"].collect()) == [1, 2, 3, 4, 5, 6]


def test_maps_and_people_of_their_own_snapshot(spark, tmp_path, lookup):
    """Six sources in one run; each snapshot has its own map and its own people."""
    square = [[[(400_000.0, 300_000.0), (401_000.0, 300_000.0), (401_000.0, 301_000.0), (400_000.0, 301_000.0)]]]
    shape = "polygons array<array<array<struct<x:double,y:double>>>>"
    node = "SELECT 'node' AS type, {id}L AS id, -1.99D AS lon, 52.6D AS lat, map('amenity', '{tag}') AS tags, CAST(NULL AS ARRAY<STRUCT<lon: DOUBLE, lat: DOUBLE>>) AS geometry, date'{day}' AS snapshot_date"
    elements = spark.sql(" UNION ALL ".join([node.format(id=1, tag="pub", day="2025-06-01"), node.format(id=2, tag="pub", day="2025-09-01"), node.format(id=3, tag="pub", day="2025-09-01")]))
    raw = pipeline.Inputs(
        lookup=lookup,
        prices=spark.sql("SELECT 100L AS price, timestamp_ntz'2025-05-01 00:00:00' AS date_of_transfer, 'P1' AS postcode, 'T' AS property_type, 'N' AS old_new, 'F' AS duration"),
        postcodes=spark.createDataFrame([("P1", "n1")], "postcode string, lsoa_code string"),
        crimes=spark.createDataFrame([("n1", "2025-05", "drugs", None, "stale")], "lsoa_code string, month string, category string, outcome_status string, district string"),
        claims=spark.createDataFrame([("N1", "may_2025", "universal_credit_no_work_required", 3)], "lsoa_name string, month string, condition_group string, value long"),
        population=spark.sql("SELECT 'n1' AS `LSOA 2021 Code`, 5L AS `F0 to 15`, date'2025-06-01' AS snapshot_date UNION ALL SELECT 'n1', 7L, date'2025-09-01'"),
        connectivity=spark.createDataFrame([("n1", 4)], "LSOA21CD string, stops long"),
        boundaries=spark.createDataFrame([("n1", 27700, square)], f"lsoa_code string, srid int, {shape}"),
        elements=elements, landuse_types=["farm"],
    )
    out = str(tmp_path / "out")
    pipeline.run(raw, out, ["2025-06-01", "2025-09-01"], months=3)
    got = {str(r.snapshot_date): r for r in readers.read_table(spark, out).filter("lsoa_code = 'n1'").collect()}
    assert [got[d].lsoa_population for d in sorted(got)] == [5, 7]
    pubs = [c for c in readers.read_table(spark, out).columns if c.startswith("count_pub") or c.startswith("count_nightlife")]
    counts = [c for c in readers.read_table(spark, out).columns if c.startswith("count_") and c.endswith("_5000")]
    assert [max(got[d][c] for c in counts) for d in sorted(got)] == [1, 2], pubs
    assert got["2025-06-01"].drugs == 1 and got["2025-06-01"].stops == 4 and got["2025-06-01"].lsoa_mean_price == 100.0
    degrees = pipeline.Inputs(lookup=lookup, boundaries=raw.boundaries.withColumn("srid", F.lit(4326)), elements=elements)
    with pytest.raises(ValueError, match="srid"):
        pipeline.feature_frames(degrees, ["2025-06-01"])


def test_pipeline_writes_replaces_and_rebuilds(spark, tmp_path, lookup):
    raw = pipeline.Inputs(
        lookup=lookup,
        prices=spark.sql("SELECT 100L AS price, timestamp_ntz'2025-03-01 00:00:00' AS date_of_transfer, 'P1' AS postcode, 'T' AS property_type, 'N' AS old_new, 'F' AS duration"),
        postcodes=spark.createDataFrame([("P1", "n1")], "postcode string, lsoa_code string"),
        crimes=spark.createDataFrame([("n9", "2025-05", "drugs", None)], "lsoa_code string, month string, category string, outcome_status string"),
    )
    out, stored = str(tmp_path / "out"), str(tmp_path / "stored")
    snapshots = ["2025-06-01", "2025-09-01"]
    pipeline.run(raw, out, snapshots, months=3, features_folder=stored)
    table = readers.read_table(spark, out)
    assert table.count() == 8 and {r.district_slug for r in table.select("district_slug").distinct().collect()} == {"d", "e"}
    first = table.filter("lsoa_code = 'n1' AND snapshot_date = date'2025-06-01'").first()
    assert first.lsoa_mean_price == 100.0 and first.drugs == 0
    again = pipeline.from_stored(spark, stored, ["prices", "crimes"], lookup, snapshots)
    assert sorted(map(str, again.select("lsoa_code", "lsoa_mean_price", "drugs").collect())) == sorted(
        map(str, table.select("lsoa_code", "lsoa_mean_price", "drugs").collect())
    )
    pipeline.run(raw, out, ["2025-09-01"], months=12)
    replaced = readers.read_table(spark, out)
    assert replaced.count() == 8
    assert replaced.filter("lsoa_code = 'n1' AND snapshot_date = date'2025-09-01'").first().lsoa_mean_price == 100.0
    assert pipeline.run_pending(raw, out, snapshots, months=12) == []
    assert pipeline.run_pending(raw, out, [*snapshots, "2025-12-01"], months=12) == ["2025-12-01"]
    assert readers.read_table(spark, out).count() == 12
