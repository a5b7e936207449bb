"""Blocks of outlines against brute force: thousands of vertices, holes, parts, points on edges and corners."""

import math

import numpy as np
import pytest

from areastats.operators import areas as area_ops, outline, spatial

DISTANCES = [0, 100, 750, 2000, 5000]


def ring(n, radius, cx, cy, seed):
    rng = np.random.default_rng(seed)
    turn = np.sort(rng.uniform(0, 2 * math.pi, n))
    r = radius * (1 + 0.3 * np.sin(5 * turn)) * rng.uniform(0.9, 1.0, n)
    return list(zip((cx + r * np.cos(turn)).round(1).tolist(), (cy + r * np.sin(turn)).round(1).tolist()))


AREAS = {
    "wide": [[ring(4000, 14_000, 500, -700, 1), ring(900, 3000, 0, 0, 2)], [ring(50, 400, 0, 0, 3)]],
    "small": [[ring(300, 200, 9000, 9000, 4)]],
    "grid": [[[(0.0, 0.0), (5000.0, 0.0), (5000.0, 5000.0), (0.0, 5000.0)], [(1000.0, 1000.0), (1000.0, 4000.0), (4000.0, 4000.0), (4000.0, 1000.0)]]],
}


def signed(px, py, polygons):
    edges = np.array([(*a, *b) for part in polygons for r in part for a, b in zip(r, r[1:] + r[:1])])
    x1, y1, x2, y2 = edges.T
    dx, dy = x2 - x1, y2 - y1
    out = np.empty(len(px))
    for k, (x, y) in enumerate(zip(px, py)):
        t = np.clip(((x - x1) * dx + (y - y1) * dy) / np.where(dx * dx + dy * dy == 0, 1, dx * dx + dy * dy), 0, 1)
        d = np.hypot(x - x1 - t * dx, y - y1 - t * dy).min()
        spans = (y1 > y) != (y2 > y)
        odd = (spans & (x < x1 + (y - y1) * dx / np.where(spans, dy, 1))).sum() % 2
        out[k] = -d if odd else d
    return out


@pytest.fixture(scope="module")
def setting(spark):
    shapes = [(k, [[[(float(x), float(y)) for x, y in r] for r in part] for part in v]) for k, v in AREAS.items()]
    raw = spark.createDataFrame(shapes, "lsoa_code string, polygons array<array<array<struct<x:double,y:double>>>>")
    areas = area_ops.with_edges(raw).cache()
    rng = np.random.default_rng(5)
    places = [(float(x), float(y)) for x, y in rng.uniform(-24_000, 24_000, (2500, 2))]
    places += [(float(x), float(y)) for x, y in rng.normal(9000, 300, (500, 2))]
    places += [(round(x / 250) * 250.0, round(y / 250) * 250.0) for x, y in rng.uniform(-1000, 6000, (400, 2))]
    places += [v for v in AREAS["wide"][0][0][::100]] + [(2500.0, 0.0), (0.0, 0.0), (5000.0, 2500.0), (1000.0, 1000.0)]
    kinds = ["pub", "school", "pub", "cafe"]
    rows = [(x, y, kinds[k % 4]) for k, (x, y) in enumerate(places)] + [(3e6, -2e6, "cinema"), (3e6 + 1, -2e6, "cinema"), (-40_000.0, 10.0, "bank")]
    points = spark.createDataFrame([(x, y, {"amenity": k}) for x, y, k in rows], "x double, y double, tags map<string,string>").cache()
    return areas, points, rows


def test_counts_and_nearest(setting):
    areas, points, rows = setting
    x, y, kind = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    groups = {"pub": ["pub"], "all": ["pub", "school", "cafe"]}
    counts = {r.lsoa_code: r for r in spatial.poi_counts(areas, points, None, groups, DISTANCES).collect()}
    pois = ["pub", "cafe", "cinema", "bank", "zoo"]
    nearest = {r.lsoa_code: r for r in spatial.poi_nearest(areas, points, pois).collect()}
    for name, polygons in AREAS.items():
        s = signed(x, y, polygons)
        for g, words in groups.items():
            for d in DISTANCES:
                assert counts[name][f"count_{g}_{d}"] == int((np.isin(kind, words) & (s < d)).sum()), (name, g, d)
        for poi in pois:
            own = s[kind == poi]
            want = pytest.approx(max(0.0, own.min()), abs=1e-6) if len(own) else None
            assert nearest[name][f"nearest_{poi}"] == want, (name, poi)


def test_one_table_of_pairs_serves_all_families(setting):
    areas, points, _ = setting
    alone = {r.lsoa_code: r for r in spatial.poi_counts(areas, points, None, {"g": ["pub"]}).collect()}
    ratio = {r.lsoa_code: r for r in spatial.poi_ratios(areas, points, {"g": ["pub"], "h": ["cafe"]}, [("g", "h")]).collect()}
    near = {r.lsoa_code: r for r in spatial.poi_nearest(areas, points, ["pub", "bank"]).collect()}
    spark = areas.sparkSession
    rings, lines = (spark.createDataFrame([], "ring array<struct<x:double,y:double>>, tags map<string,string>") for _ in range(2))
    groups = {"g": ["pub"], "h": ["cafe"]}
    together = spatial.map_features(areas, points, rings, lines, groups=groups, pois=["pub", "bank"], pairs=[("g", "h")], landuse_types=["farm"])
    for r in together.collect():
        for held in (alone, ratio, near):
            for c in held[r.lsoa_code].asDict():
                assert r[c] == held[r.lsoa_code][c], c


def test_blocks_hold_few_edges(setting):
    areas, _, _ = setting
    index = outline.outline_index(areas, ["lsoa_code"], 2000.0, 1000.0)
    sizes = {(r.lsoa_code, r.bx, r.by): len(r.near or []) for r in index.collect()}
    whole = {r.lsoa_code: len(r.edges) for r in areas.collect()}
    assert max(n for (k, *_), n in sizes.items() if k == "wide") < whole["wide"] / 3
    assert "edges" not in index.columns and any(n == 0 for (k, *_), n in sizes.items() if k == "wide")
