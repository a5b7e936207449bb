"""Area boundaries: parsing, checks, derived geometry, bounding boxes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.constants import METRES_PER_DEGREE
from areastats.functions import geometry as G

GRID_SRID = 27700
BOX = ("minx", "miny", "maxx", "maxy")


def parse_geojson(shape: Column) -> Column:
    """GeoJSON text of a Polygon or MultiPolygon (bare or inside a Feature) -> polygons."""
    body = F.coalesce(F.get_json_object(shape, "$.geometry"), shape)
    point = "ARRAY<DOUBLE>"

    def rings(nested: Column) -> Column:
        return F.transform(nested, lambda part: F.transform(part, lambda ring: F.transform(
            ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
        )))

    one = F.from_json(body, f"coordinates ARRAY<ARRAY<{point}>>")["coordinates"]
    many = F.from_json(body, f"coordinates ARRAY<ARRAY<ARRAY<{point}>>>")["coordinates"]
    return F.when(F.get_json_object(body, "$.type") == "Polygon", rings(F.array(one))).otherwise(rings(many))


def check_srid(areas: DataFrame, srid: int = GRID_SRID) -> DataFrame:
    """Raise unless every boundary is on the metric grid."""
    if areas.filter(~F.col("srid").eqNullSafe(srid)).limit(1).count():
        raise ValueError(f"boundaries must have srid {srid}")
    return areas


def with_edges(areas: DataFrame, keys: Sequence[str] = ("lsoa_code",), polygons: str = "polygons") -> DataFrame:
    """Keys, edges, bounding box, area, and whether the area is one convex ring."""
    single = (F.size(polygons) == 1) & (F.size(F.col(polygons)[0]) == 1)
    return (
        areas.select(*keys, single.alias("_single"), F.explode(F.array(G.polygon_edges(F.col(polygons)))).alias("edges"))
        .select("*", *[c.alias(n) for n, c in G.bounds(F.col("edges")).items()])
        .select(
            *keys, "edges", *BOX,
            G.signed_area(F.col("edges")).alias("area"),
            (F.col("_single") & G.is_convex(F.col("edges"))).alias("convex"),
        )
    )


def district_bbox(areas: DataFrame, buffer_m: float = 0, per_degree: float = METRES_PER_DEGREE) -> DataFrame:
    """Bounding box of each district's boundaries in degrees, widened by buffer_m."""
    grow = buffer_m / per_degree
    edges = F.col("edges")
    box = F.struct(*[c.alias(n) for n, c in G.bounds(edges).items()])
    boxed = areas.select("district", F.explode(F.array(box)).alias("b"))
    return boxed.groupBy("district").agg(
        (F.min("b.miny") - grow).alias("min_lat"),
        (F.min("b.minx") - grow).alias("min_lon"),
        (F.max("b.maxy") + grow).alias("max_lat"),
        (F.max("b.maxx") + grow).alias("max_lon"),
    )


def largest_parts(areas: DataFrame, keys: Sequence[str] = ("lsoa_code",), polygons: str = "polygons") -> DataFrame:
    """The largest part of each boundary, with its area."""
    part = areas.select(*keys, G.largest_part(F.col(polygons)).alias("part"))
    return part.withColumn("part_area", G.part_area(F.col("part")))


def cover(df: DataFrame, size: float, grow: Column | float = 0.0, cells: tuple[str, str] = ("bx", "by")) -> DataFrame:
    """One copy of a row per grid cell its (widened) bounding box meets."""

    def span(low, high):
        return F.sequence(
            F.floor((F.col(low) - grow) / size).cast("long"), F.floor((F.col(high) + grow) / size).cast("long")
        )

    return df.withColumn(cells[0], F.explode(span("minx", "maxx"))).withColumn(
        cells[1], F.explode(span("miny", "maxy"))
    )


def meeting_pairs(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs whose bounding boxes meet, each once.

    Both sides spread over grid cells and meet in an equi-join; a pair is kept only in
    the cell that holds the lower-left corner of the two boxes' common part, so no
    distinct is needed. Box columns come out as l_* and r_*.
    """
    left = left.withColumnsRenamed({b: f"l_{b}" for b in BOX})
    right = right.withColumnsRenamed({b: f"r_{b}" for b in BOX})

    def spread(df, side):
        def span(axis):
            low, high = (F.floor(F.col(f"{side}_{end}{axis}") / size).cast("long") for end in ("min", "max"))
            return F.explode(F.sequence(low, high))

        return df.withColumn("_cx", span("x")).withColumn("_cy", span("y"))

    corner_x = F.greatest("l_minx", "r_minx")
    corner_y = F.greatest("l_miny", "r_miny")
    return (
        spread(left, "l").join(spread(right, "r"), ["_cx", "_cy"])
        .filter(
            (corner_x <= F.least("l_maxx", "r_maxx")) & (corner_y <= F.least("l_maxy", "r_maxy"))
            & (F.floor(corner_x / size) == F.col("_cx")) & (F.floor(corner_y / size) == F.col("_cy"))
        )
        .drop("_cx", "_cy")
    )
