"""Planar geometry as array expressions; predicates between shapes are in `kernels`.

ring     array<struct<x,y>>, closed or not
polygons array<array<ring>>: parts, each an outer ring followed by its holes
edges    array<struct<x1,y1,x2,y2>>; outer rings counter-clockwise, holes clockwise
"""

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it by name in `body`."""
    return F.transform(F.array(value), body)[0]


def close_ring(ring: Column) -> Column:
    first = F.slice(ring, 1, 1)
    return F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(F.concat(ring, first))


def path_edges(path: Column) -> Column:
    """Consecutive node pairs."""
    count = F.greatest(F.size(path) - 1, F.lit(0))
    return F.zip_with(
        F.slice(path, F.lit(1), count),
        F.slice(path, F.lit(2), count),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )


def signed_area(edges: Column) -> Column:
    """Shoelace sum about the first node; positive when counter-clockwise."""
    return let(edges[0], lambda o: F.aggregate(
        edges,
        F.lit(0.0),
        lambda acc, e: acc
        + (e["x1"] - o["x1"]) * (e["y2"] - o["y1"])
        - (e["x2"] - o["x1"]) * (e["y1"] - o["y1"]),
    )) / 2


def _reversed(edges: Column) -> Column:
    """The same outline walked the other way."""
    return F.transform(F.reverse(edges), lambda e: F.struct(
        e["x2"].alias("x1"), e["y2"].alias("y1"), e["x1"].alias("x2"), e["y1"].alias("y2")
    ))


def ring_edges(ring: Column, outer: Column | bool = True) -> Column:
    """Edges of a ring, turned counter-clockwise when outer and clockwise when a hole."""
    outer = F.lit(outer) if isinstance(outer, bool) else outer
    return let(path_edges(close_ring(ring)), lambda e: F.when((signed_area(e) >= 0) == outer, e).otherwise(_reversed(e)))


def polygon_edges(polygons: Column) -> Column:
    return F.flatten(F.transform(
        polygons, lambda part: F.flatten(F.transform(part, lambda ring, i: ring_edges(ring, i == 0)))
    ))


def part_area(part: Column) -> Column:
    """Outer ring minus holes."""
    return signed_area_sum(F.transform(part, lambda ring, i: signed_area(ring_edges(ring, i == 0))))


def signed_area_sum(areas: Column) -> Column:
    return F.aggregate(areas, F.lit(0.0), lambda acc, a: acc + a)


def largest_part(polygons: Column) -> Column:
    """The part with the largest area."""
    sized = F.transform(polygons, lambda p: F.struct(part_area(p).alias("area"), p.alias("part")))
    return F.array_max(sized)["part"]


def bounds(edges: Column) -> dict[str, Column]:
    return {
        "minx": F.array_min(F.transform(edges, lambda e: F.least(e["x1"], e["x2"]))),
        "miny": F.array_min(F.transform(edges, lambda e: F.least(e["y1"], e["y2"]))),
        "maxx": F.array_max(F.transform(edges, lambda e: F.greatest(e["x1"], e["x2"]))),
        "maxy": F.array_max(F.transform(edges, lambda e: F.greatest(e["y1"], e["y2"]))),
    }


def is_convex(edges: Column) -> Column:
    """For the edges of one counter-clockwise ring."""
    following = F.concat(F.slice(edges, F.lit(2), F.size(edges) - 1), F.slice(edges, 1, 1))
    turns = F.zip_with(edges, following, lambda a, b: (
        (a["x2"] - a["x1"]) * (b["y2"] - b["y1"]) - (a["y2"] - a["y1"]) * (b["x2"] - b["x1"])
    ))
    return F.forall(turns, lambda t: t >= 0)


def box_gap2(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Squared distance between two boxes."""
    zero = F.lit(0.0)
    gx = F.greatest(a["minx"] - b["maxx"], b["minx"] - a["maxx"], zero)
    gy = F.greatest(a["miny"] - b["maxy"], b["miny"] - a["maxy"], zero)
    return gx * gx + gy * gy
