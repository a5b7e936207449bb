"""Geometry and projection against hand-computed shapes."""

import pytest
from pyspark.sql import functions as F

from areastats.functions import geometry as G, kernels as K
from areastats.functions.grid import add_grid, airy_to_grid_array

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
L_SHAPE = [[[(0.0, 0.0), (10.0, 0.0), (10.0, 4.0), (4.0, 4.0), (4.0, 10.0), (0.0, 10.0)]]]
SQUARE = [[[(2.0, 2.0), (8.0, 2.0), (8.0, 8.0), (2.0, 8.0)]]]
HOLED = [[[(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)], [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]]]
TWO_PARTS = [[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]], [[(5.0, 0.0), (9.0, 0.0), (9.0, 4.0), (5.0, 4.0)]]]
TRIANGLE = [[[(0.0, 0.0), (8.0, 0.0), (0.0, 8.0)]]]
SHIFTED = [[[(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)]]]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(L_SHAPE, SQUARE, HOLED, TWO_PARTS, TRIANGLE, SHIFTED)]
    names = ["ell", "square", "holed", "parts", "triangle", "shifted"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {POLYGONS}" for n in names))
    return df.select("parts", *[G.polygon_edges(F.col(n)).alias(f"e_{n}") for n in names]).repartition(1).cache()


def value(df, column):
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize("name,area", [("ell", 64), ("square", 36), ("holed", 96), ("parts", 20), ("triangle", 32)])
def test_area(shapes, name, area):
    assert value(shapes, G.signed_area(F.col(f"e_{name}"))) == pytest.approx(area)


@pytest.mark.parametrize("a,b,area", [
    ("ell", "square", 20),
    ("holed", "square", 32),
    ("ell", "holed", 64),  # shared outer edges; the hole only touches the notch corner
    ("ell", "ell", 64),
    ("square", "square", 36),
    ("triangle", "square", 8),
    ("triangle", "ell", 32),
    ("parts", "square", 6),
    ("holed", "shifted", 0),  # a shared edge that runs the other way
    ("holed", "triangle", 32),
])
def test_overlap_area(shapes, a, b, area):
    for x, y in ((a, b), (b, a)):
        got = value(shapes, K.overlap_area(f"e_{x}", f"e_{y}"))
        assert got == pytest.approx(area), (x, y)


def test_signed_distance(shapes):
    def at(x, y, name):
        return value(shapes, K.signed_distance(F.lit(x), F.lit(y), f"e_{name}"))

    assert at(5.0, 5.0, "holed") == pytest.approx(1)
    assert at(1.0, 1.0, "ell") == pytest.approx(-1)
    assert at(7.0, 7.0, "ell") == pytest.approx(3)
    assert at(0.0, 5.0, "ell") == 0
    assert at(-3.0, -4.0, "ell") == pytest.approx(5)
    assert at(3.5, 1.0, "parts") == pytest.approx(1.5)


def test_convex(shapes):
    assert value(shapes, G.is_convex(F.col("e_square"))) and value(shapes, G.is_convex(F.col("e_triangle")))
    assert not value(shapes, G.is_convex(F.col("e_ell")))


def test_largest_part(shapes):
    part = value(shapes, G.largest_part(F.col("parts")))
    assert [tuple(p) for p in part[0]] == TWO_PARTS[1][0]


@pytest.mark.parametrize("path,name,length", [
    ([(-5.0, 2.0), (15.0, 2.0)], "ell", 10),
    ([(-5.0, 5.0), (15.0, 5.0)], "ell", 4),
    ([(-5.0, 5.0), (15.0, 5.0)], "holed", 8),
    ([(0.0, -5.0), (0.0, 15.0)], "ell", 10),  # along the boundary
    ([(1.0, 1.0), (3.0, 3.0)], "square", 2**0.5),
    ([(1.0, 1.0), (1.0, 9.0), (9.0, 9.0)], "ell", 11),
    ([(20.0, 20.0), (30.0, 30.0)], "ell", 0),
])
def test_clipped_length(spark, shapes, path, name, length):
    df = shapes.crossJoin(spark.createDataFrame([(path,)], "path array<struct<x:double,y:double>>"))
    df = df.withColumn("seg", G.path_edges(F.col("path")))
    got = value(df, K.clipped_length("seg", f"e_{name}"))
    assert got == pytest.approx(length)


def test_published_projection_example(spark):
    df = spark.sql(
        "SELECT array(named_struct('lon', radians(1 + 43/60D + 4.5177D/3600), 'lat', radians(52 + 39/60D + 27.2531D/3600))) AS p"
    )
    got = df.select(airy_to_grid_array(F.col("p"))[0].alias("g")).first().g
    assert got.x == pytest.approx(651409.9030, abs=5e-4)
    assert got.y == pytest.approx(313177.2703, abs=5e-4)


def test_wgs84_to_grid_is_within_metres(spark):
    """A point of known grid reference (Bristol Temple Meads, about ST 597 724)."""
    g = add_grid(spark.sql("SELECT -2.5813D AS lon, 51.4493D AS lat")).first()
    assert g.x == pytest.approx(359700, abs=150) and g.y == pytest.approx(172400, abs=150)
