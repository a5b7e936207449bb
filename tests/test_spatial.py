"""Spatial operators against brute force on shapes that squares cannot stand for."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from areastats.functions.tags import count_groups, nearest_pois, ratio_groups
from areastats.operators import areas as area_ops, spatial
from areastats.sources import map_elements

AREAS = {
    "ell": [[[(0, 0), (3000, 0), (3000, 1000), (1000, 1000), (1000, 3000), (0, 3000)]]],
    "holed": [[[(4000, 0), (4000, 3000), (7000, 3000), (7000, 0)], [(5000, 1000), (6000, 1000), (6000, 2000), (5000, 2000)]]],
    "parts": [[[(-4000, -4000), (-3000, -4000), (-3500, -3000)]], [[(-2000, -4000), (-1500, -4000), (-1500, -3800), (-2000, -3800)]]],
}
DISTANCES = [0, 250, 1000, 5000]


def edges_of(polygons):
    out = []
    for part in polygons:
        for ring in part:
            closed = [*ring, ring[0]]
            out += list(zip(closed[:-1], closed[1:]))
    return out


def signed(p, edges):
    best, odd = math.inf, False
    for (x1, y1), (x2, y2) in edges:
        dx, dy = x2 - x1, y2 - y1
        t = min(1, max(0, ((p[0] - x1) * dx + (p[1] - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(p[0] - x1 - t * dx, p[1] - y1 - t * dy))
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) * dx / dy:
            odd = not odd
    return -best if odd else best


@pytest.fixture(scope="module")
def areas(spark):
    rows = [(k, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in v]) for k, v in AREAS.items()]
    raw = spark.createDataFrame(rows, "lsoa_code string, polygons array<array<array<struct<x:double,y:double>>>>")
    return area_ops.with_edges(raw).cache()


@pytest.fixture(scope="module")
def places():
    """Spread points, a crowded tile with many copies, and boundary points."""
    rng = np.random.default_rng(11)
    spread = [(float(x), float(y)) for x, y in rng.uniform(-9000, 12000, (600, 2))]
    crowd = [(float(x), float(y)) for x, y in rng.uniform(900, 1140, (150, 2))]
    copies = [(1010.0, 1010.0)] * 200
    edge = [(0.0, 500.0), (5000.0, 1500.0), (3000.0, 0.0)]
    kinds = ["pub", "school", "pub", "shop", "other"]
    return [(i, x, y, kinds[i % 5]) for i, (x, y) in enumerate(spread + crowd + copies + edge)]


@pytest.fixture(scope="module")
def points(spark, places):
    rows = [(i, x, y, {"amenity": kind} if kind != "shop" else {"shop": "yes"}) for i, x, y, kind in places]
    return spark.createDataFrame(rows, "id long, x double, y double, tags map<string,string>").cache()


def test_counts(areas, points, places):
    groups = {"drink": ["pub"], "learn": ["school", "college"], "both": ["pub", "school"]}
    got = {r.lsoa_code: r for r in spatial.poi_counts(areas, points, None, groups, DISTANCES).collect()}
    for name, polygons in AREAS.items():
        edges = edges_of(polygons)
        for group, words in groups.items():
            for d in DISTANCES:
                want = sum(1 for _, x, y, k in places if k in words and signed((x, y), edges) < d)
                assert got[name][f"count_{group}_{d}"] == want, (name, group, d)


def test_ratios_see_keys_and_stay_null_without_a_denominator(areas, points, places):
    groups = {"trade": ["shop"], "drink": ["pub"], "none": ["zoo"]}
    pairs = [("trade", "drink"), ("trade", "none")]
    got = {r.lsoa_code: r for r in spatial.poi_ratios(areas, points, groups, pairs, [1000, 2000]).collect()}
    for name, polygons in AREAS.items():
        edges = edges_of(polygons)
        for d in (1000, 2000):
            a = sum(1 for _, x, y, k in places if k == "shop" and signed((x, y), edges) < d)
            b = sum(1 for _, x, y, k in places if k == "pub" and signed((x, y), edges) < d)
            assert got[name][f"ratio_trade_to_drink_{d}"] == pytest.approx(a / b)
            assert got[name][f"ratio_trade_to_none_{d}"] is None


def test_nearest_within_and_far_beyond_reach(spark, areas, points, places):
    far = [("cinema", 90000.0, -41000.0), ("cinema", 91000.0, 400.0), ("theatre", -700000.0, 300000.0), ("bar", 9000.0, 9000.0)]
    extra = spark.createDataFrame([(10**6 + i, x, y, {"amenity": k}) for i, (k, x, y) in enumerate(far)], points.schema)
    pois = ["pub", "shop", "cinema", "theatre", "bar", "bank"]
    got = {r.lsoa_code: r for r in spatial.poi_nearest(areas, points.unionAll(extra), pois, reach=1500.0).collect()}
    everything = [(k, x, y) for _, x, y, k in places] + far
    for name, polygons in AREAS.items():
        edges = edges_of(polygons)
        for poi in pois:
            all_d = [max(0.0, signed((x, y), edges)) for k, x, y in everything if k == poi]
            assert got[name][f"nearest_{poi}"] == (pytest.approx(min(all_d)) if all_d else None), (name, poi)


def test_polygons_in_buffers(spark, areas):
    rng = np.random.default_rng(3)
    rings = [[(500.0, 500.0), (2500.0, 500.0), (500.0, 2500.0)]]  # corners inside the L, long side outside
    rings += [[(4500.0, 500.0), (6500.0, 500.0), (6500.0, 2500.0), (4500.0, 2500.0)]]  # around the hole
    rings += [[(0.0, 0.0), (1000.0, 0.0), (1000.0, 1000.0), (0.0, 1000.0)]]  # touches the boundary from inside
    for cx, cy in rng.uniform(-5000, 8000, (40, 2)):
        w, h = rng.uniform(20, 900, 2)
        rings.append([(cx, cy), (cx + w, cy + h / 3), (cx + w / 2, cy + h)])
    rings += [rings[0]] * 3
    df = spark.createDataFrame(
        [([(float(x), float(y)) for x, y in r], {"amenity": "pub"}) for r in rings],
        "ring array<struct<x:double,y:double>>, tags map<string,string>",
    )
    no_points = spark.createDataFrame([], "x double, y double, tags map<string,string>")
    got = {r.lsoa_code: r for r in spatial.poi_counts(areas, no_points, df, {"g": ["pub"]}, DISTANCES).collect()}

    def outline(ring, step=2.0):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            n = max(1, math.ceil(math.hypot(x2 - x1, y2 - y1) / step))
            yield from ((x1 + (x2 - x1) * i / n, y1 + (y2 - y1) * i / n) for i in range(n))

    for name, polygons in AREAS.items():
        edges = edges_of(polygons)
        far = [max(signed(p, edges) for p in outline(r)) for r in rings]
        for d in DISTANCES:
            want = sum(1 for r, f in zip(rings, far) if f <= d and not (d == 0 and name == "holed" and r is rings[1]))
            assert got[name][f"count_g_{d}"] == want, (name, d)


def test_landuse_of_a_tiling_adds_up(spark, areas):
    """Cells of a grid that covers everything: shares add up to 1; a copy counts twice."""
    cells = []
    for i in range(-5, 8):
        for j in range(-5, 4):
            x, y = i * 1000.0 + 7, j * 1000.0 + 3
            cells.append(([(x, y), (x + 1000, y), (x + 1000, y + 1000), (x, y + 1000)], {"landuse": f"t{(i + j) % 3}"}))
    df = spark.createDataFrame(cells, "ring array<struct<x:double,y:double>>, tags map<string,string>")
    long = spatial.landuse_long(areas, df, cell=700.0).groupBy("lsoa_code").agg(F.sum("share").alias("s")).collect()
    assert {r.lsoa_code: round(r.s, 9) for r in long} == {k: 1.0 for k in AREAS}
    twice = spatial.landuse_shares(areas, df.unionAll(df), ["t0", "t1", "t2", "absent"]).collect()
    for r in twice:
        assert r.landuse_t0_0 + r.landuse_t1_0 + r.landuse_t2_0 == pytest.approx(2.0) and r.landuse_absent_0 == 0


def test_landuse_discovers_types(spark, areas):
    df = spark.createDataFrame([([(0.0, 0.0), (100.0, 0.0), (100.0, 100.0)], {"landuse": "farm"}), ([(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)], {"x": "y"})],
                               "ring array<struct<x:double,y:double>>, tags map<string,string>")
    got = {r.lsoa_code: r.landuse_farm_0 for r in spatial.landuse_shares(areas, df).collect()}
    assert got["ell"] == pytest.approx(5000 / 5e6) and got["parts"] == 0


def test_streetlit(spark, areas):
    lines = [
        ([(-500.0, 500.0), (3500.0, 500.0)], {"highway": "path", "lit": "yes"}),
        ([(500.0, -500.0), (500.0, 3500.0)], {"highway": "path", "lit": "no"}),
        ([(5500.0, -100.0), (5500.0, 3100.0)], {"highway": "path"}),
    ]
    df = spark.createDataFrame(lines, "ring array<struct<x:double,y:double>>, tags map<string,string>")
    got = {r.lsoa_code: r.streetlit_percentage for r in spatial.streetlit_share(areas, df).collect()}
    assert got == {"ell": pytest.approx(0.5), "holed": 0.0}


def test_tag_predicates(spark):
    groups = {"a": ["pub", "bar"], "b": ["bar", "atm"]}
    rows = [(1, {"amenity": "pub", "shop": "bar"}), (2, {"atm": "yes"}), (3, {"name": "pub"}), (4, None), (5, {"highway": "atm"})]
    df = spark.createDataFrame(rows, "id int, tags map<string,string>").select(
        "id", count_groups(F.col("tags"), groups).alias("c"), ratio_groups(F.col("tags"), groups).alias("r"), nearest_pois(F.col("tags"), ["pub", "atm"]).alias("n")
    )
    got = {r.id: (r.c, r.r, r.n) for r in df.collect()}
    assert got[1] == (["a", "b"], ["a", "b"], ["pub"])
    assert got[2] == ([], ["b"], ["atm"])
    assert got[3] == ([], [], [])
    assert got[4] == ([], [], [])
    assert got[5] == (["b"], ["b"], ["atm"])


def test_split_and_projection_of_elements(spark):
    node = [(-2.58, 51.45)]
    ring = [(-2.58, 51.45), (-2.57, 51.45), (-2.57, 51.46), (-2.58, 51.45)]
    rows = [
        ("node", 1, -2.58, 51.45, {"amenity": "pub"}, None), ("way", 2, None, None, {"landuse": "farm"}, ring),
        ("way", 3, None, None, {"highway": "path"}, ring[:2]), ("way", 4, None, None, {"amenity": "bench"}, ring[:3]),
        ("way", 5, None, None, None, ring), ("relation", 6, None, None, {"landuse": "farm"}, None),
    ]
    df = spark.createDataFrame(rows, "type string, id long, lon double, lat double, tags map<string,string>, geometry array<struct<lon:double,lat:double>>")
    points, polygons, lines = map_elements.split_elements(df)
    assert [[r.id for r in x.orderBy("id").collect()] for x in (points, polygons, lines)] == [[1], [2, 5], [3]]
    at = map_elements.points_to_grid(points).first()
    first = map_elements.ways_to_grid(polygons.filter("id = 2")).first().ring[0]
    assert (at.x, at.y) == (pytest.approx(first.x), pytest.approx(first.y)) and node


def test_boundaries(spark, areas):
    bad = spark.createDataFrame([("a", 4326)], "lsoa_code string, srid int")
    with pytest.raises(ValueError, match="27700"):
        area_ops.check_srid(bad)
    good = bad.withColumn("srid", F.lit(27700))
    assert area_ops.check_srid(good) is good
    text = '{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]],[[[10,0],[12,0],[12,2],[10,2],[10,0]]]]}}'
    df = spark.createDataFrame([("a", text)], "lsoa_code string, shape string")
    row = area_ops.with_edges(df.select("lsoa_code", area_ops.parse_geojson(F.col("shape")).alias("polygons"))).first()
    assert row.area == pytest.approx(16 - 1 + 4) and len(row.edges) == 12 and not row.convex
    assert (row.minx, row.maxx, row.maxy) == (0, 12, 4)


def test_nearest_at_any_distance_and_reach(spark, areas):
    spots = [(300_000.0, 50.0, "pub"), (20_000_000.0, 0.0, "cafe"), (5000.5, 500.0, "school")]
    df = spark.createDataFrame([(x, y, {"amenity": t}) for x, y, t in spots], "x double, y double, tags map<string,string>")
    for reach in (0, 100, 5000):
        got = {r.lsoa_code: r for r in spatial.poi_nearest(areas, df, ["pub", "cafe", "school"], reach=reach).collect()}
        for name, polygons in AREAS.items():
            for x, y, tag in spots:
                assert got[name][f"nearest_{tag}"] == pytest.approx(max(0.0, signed((x, y), edges_of(polygons)))), (reach, name, tag)


def test_polygons_inside_only(spark, areas):
    ring = [(100.0, 100.0), (200.0, 100.0), (150.0, 200.0)]
    df = spark.createDataFrame([([*ring], {"amenity": "pub"})], "ring array<struct<x:double,y:double>>, tags map<string,string>")
    no_points = spark.createDataFrame([], "x double, y double, tags map<string,string>")
    got = {r.lsoa_code: r.count_g_0 for r in spatial.poi_counts(areas, no_points, df, {"g": ["pub"]}, [0]).collect()}
    assert got == {name: int(all(signed(p, edges_of(polygons)) <= 0 for p in ring)) for name, polygons in AREAS.items()}


def test_farthest_point_between_bounds():
    """The band is right to a centimetre, where samples 5 m apart would miss the farthest point."""
    import pyarrow as pa

    from areastats.functions import kernels as K

    rng = np.random.default_rng(5)
    area = [(*a, *b) for a, b in edges_of(AREAS["holed"])]
    shapes, truth = [], []
    for _ in range(30):
        corners = rng.uniform(-2000, 8000, (4, 2))
        edges = [(*corners[i], *corners[(i + 1) % 4]) for i in range(4)]
        shapes.append(edges)
        along = [(x1 + (x2 - x1) * k / 4000, y1 + (y2 - y1) * k / 4000) for x1, y1, x2, y2 in edges for k in range(4001)]
        truth.append(K._signed(np.array([p[0] for p in along]), np.array([p[1] for p in along]), np.zeros(len(along), int), K._Lists(pa.array([[dict(zip(K.EDGE_FIELDS, e)) for e in area]]))).max())
    as_rows = lambda rows: pa.array([[dict(zip(K.EDGE_FIELDS, map(float, e))) for e in r] for r in rows])
    bounds = np.array([t - 0.5 for t in truth[:10]] + [t + 0.5 for t in truth[10:20]])
    far = K._farthest_along(as_rows(shapes), as_rows([area] * len(shapes)), bounds).to_numpy()
    band = lambda v: np.searchsorted(np.sort(bounds), v)
    assert (band(far) == band(np.array(truth))).all()


def test_map_features_name_the_points_once(spark, monkeypatch):
    from areastats import registry
    from areastats.operators import spatial as operators

    kept = []
    monkeypatch.setattr(operators, "stored", lambda df, own=operators.stored: kept.append(df) or own(df))
    registry.QUERIES["map_features"](spark, "/root/testdata/sf0.001")
    places = [df for df in kept if df.columns == ["x", "y", "measures", "n", "tx", "ty"]]
    assert len(places) == 1
    scans = [df._jdf.queryExecution().executedPlan().toString().count("events.parquet") for df in kept]
    assert sum(scans) == 1
