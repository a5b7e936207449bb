"""Outlines by block: what a place needs to know its signed distance to an area, without the outline.

The plane is cut into square blocks. For each block in reach of an area the index holds

* the edges that can be nearest to some place of the block: of the outline's parts (runs of PART
  edges) those whose box is no farther than the surest other part, and
* whether the block's reference point lies inside, from the crossings of one line per row of
  blocks with the outline.

Inside or outside of any place of the block follows from the reference point and the edges
crossed on the way, first along y, then along x; all of these meet the block and are in the index.
Reference points are off round coordinates, on which real outlines like to lie.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from areastats.functions import geometry as G
from areastats.operators.areas import BOX, cover

PART = 16
OFF_X, OFF_Y = 0.271828, 0.141593
SLACK = 1e-6


def parts(areas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of PART consecutive edges of each outline: (keys, edges, box)."""
    edges = F.col("edges")
    count = F.ceil(F.size(edges) / PART).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(edges, i * PART + 1, F.lit(PART)))
    rows = areas.filter(F.size(edges) > 0).select(*keys, F.explode(cut).alias("edges"))
    return rows.select(*keys, "edges", *[c.alias(n) for n, c in G.bounds(F.col("edges")).items()])


def _reference(b: Column, block: float, off: float) -> Column:
    return (b + 0.5) * block + off


def _crossings(outline: DataFrame, keys: Sequence[str], block: float) -> DataFrame:
    """(keys, by, xs): where the outline crosses the line through the reference points of a row of blocks."""
    row = lambda y: F.floor((F.col(y) - OFF_Y) / block - 0.5).cast("long")
    lined = outline.withColumn("by", F.explode(F.sequence(row("miny"), row("maxy") + 1)))
    y = _reference(F.col("by"), block, OFF_Y)
    single = lined.filter((F.col("miny") <= y) & (F.col("maxy") >= y)).select(*keys, "by", F.inline("edges"))
    spans = (F.col("y1") > y) != (F.col("y2") > y)
    at = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return single.filter(spans).groupBy(*keys, "by").agg(F.collect_list(at).alias("xs"))


def outline_index(areas: DataFrame, keys: Sequence[str], block: float, reach: float) -> DataFrame:
    """(keys, bx, by, near, rx, ry, inside, box): one row per area and block that may be within `reach`.

    A block without edges in reach is there only where it lies inside.
    """
    keys = list(keys)
    outline = parts(areas, keys)
    blocks = cover(areas.select(*keys, *BOX), block, reach + SLACK)
    low_x, low_y = F.col("bx") * block, F.col("by") * block
    own = {"minx": low_x, "miny": low_y, "maxx": low_x + block, "maxy": low_y + block}
    lo = F.sqrt(G.box_gap2({b: F.col(b) for b in BOX}, own))
    first = F.col("edges")[0]
    wide = F.greatest(F.abs(first["x1"] - own["minx"]), F.abs(first["x1"] - own["maxx"]))
    high = F.greatest(F.abs(first["y1"] - own["miny"]), F.abs(first["y1"] - own["maxy"]))
    near = (
        cover(outline, block, reach + SLACK)
        .select(*keys, "bx", "by", F.struct(lo.alias("lo"), "edges").alias("part"), F.sqrt(wide * wide + high * high).alias("hi"))
        .filter(F.col("part.lo") <= reach + SLACK)
        .groupBy(*keys, "bx", "by")
        .agg(F.collect_list("part").alias("parts"), F.min("hi").alias("hi"))
        .select(*keys, "bx", "by", F.flatten(F.transform(F.filter("parts", lambda p: p["lo"] <= F.col("hi") + SLACK), lambda p: p["edges"])).alias("near"))
    )
    rx, ry = _reference(F.col("bx"), block, OFF_X), _reference(F.col("by"), block, OFF_Y)
    right = F.size(F.filter(F.coalesce("xs", F.array().cast("array<double>")), lambda x: x > F.col("rx")))
    return (
        blocks.join(near, [*keys, "bx", "by"], "left")
        .join(_crossings(outline, keys, block), [*keys, "by"], "left")
        .withColumn("rx", rx).withColumn("ry", ry)
        .select(*keys, "bx", "by", "near", "rx", "ry", (right % 2 == 1).alias("inside"), *BOX)
        .filter(F.col("near").isNotNull() | F.col("inside"))
    )
