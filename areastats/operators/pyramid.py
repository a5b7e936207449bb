"""Nearest places at any distance: a pyramid of cells, searched from the top.

Each level is aggregated from the one below, FACTOR cells wide, with the box of what its cells hold.
From the top, a cell stays for an (area, measure) when its nearest possible place beats the
farthest possible nearest one of another cell; only the children of these meet the next level.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from areastats.functions import geometry as G, kernels as K
from areastats.functions.parallel import shared
from areastats.operators.areas import BOX
from areastats.operators.outline import SLACK, parts

FACTOR = 8
#: Metres that a top cell is wide at least; more of them only make the first round longer.
TOP = 4_000_000.0


def pyramid(tiles: DataFrame, tile: float) -> list[DataFrame]:
    """Levels from the tiles (measure, gx, gy, box) up; parents have the coordinates over FACTOR."""
    levels, width = [tiles], tile
    while width < TOP:
        up = [F.floor(F.col(g) / FACTOR).cast("long").alias(g) for g in ("gx", "gy")]
        sides = [(F.min if b.startswith("min") else F.max)(b).alias(b) for b in BOX]
        levels.append(shared(levels[-1].select("measure", *up, *BOX).groupBy("measure", "gx", "gy").agg(*sides)))
        width *= FACTOR
    return levels


def _farthest(x: Column, y: Column, box: dict[str, Column]) -> Column:
    dx = F.greatest(F.abs(x - box["minx"]), F.abs(x - box["maxx"]))
    dy = F.greatest(F.abs(y - box["miny"]), F.abs(y - box["maxy"]))
    return F.sqrt(dx * dx + dy * dy)


def _box(prefix: str) -> dict[str, Column]:
    return {b: F.col(prefix + b) for b in BOX}


def _pruned(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can hold the nearest place: of area box, point (ax, ay) of the outline, and box t_ of places."""
    low, high = F.sqrt(G.box_gap2(_box("a_"), _box("t_"))), _farthest(F.col("ax"), F.col("ay"), _box("t_"))
    best = F.min(high).over(Window.partitionBy(*keys, "measure"))
    return rows.withColumn("_best", best).filter(low <= F.col("_best") + SLACK).drop("_best")


def farther(
    areas: DataFrame, missing: DataFrame, tiles: DataFrame, places: DataFrame, keys: Sequence[str], tile: float
) -> DataFrame:
    """(keys, measure, distance) of the nearest place, for pairs `missing` (keys, measure) whose area holds no such place.

    `tiles` has (measure, gx, gy, box) of occupied tiles, `places` (tx, ty, x, y, measure).
    """
    keys = list(keys)
    first = F.col("edges")[0]
    sought = missing.join(
        areas.select(*keys, first["x1"].alias("ax"), first["y1"].alias("ay"), *[F.col(b).alias(f"a_{b}") for b in BOX]), keys
    )
    levels = [level.withColumnsRenamed({b: f"t_{b}" for b in BOX}) for level in pyramid(tiles, tile)]
    held = [*keys, "measure", "ax", "ay", *[f"a_{b}" for b in BOX]]
    found = _pruned(sought.join(levels[-1], "measure"), keys)
    for level in reversed(levels[:-1]):
        parents = found.select(*held, F.col("gx").alias("px"), F.col("gy").alias("py"))
        below = level.withColumn("px", F.floor(F.col("gx") / FACTOR).cast("long")).withColumn("py", F.floor(F.col("gy") / FACTOR).cast("long"))
        found = _pruned(parents.join(below, ["measure", "px", "py"]), keys)
    # of the outline, only the parts that may be nearest to one of the tiles
    outline = parts(areas, keys).withColumnsRenamed({b: f"a_{b}" for b in BOX})
    corner = F.col("edges")[0]
    near = _pruned(
        found.select(*keys, "measure", "gx", "gy", *[f"t_{b}" for b in BOX]).join(outline.withColumn("ax", corner["x1"]).withColumn("ay", corner["y1"]), keys), keys
    )
    return (
        near.select(*keys, "measure", F.col("gx").alias("tx"), F.col("gy").alias("ty"), "edges")
        .join(places, ["tx", "ty", "measure"])
        .withColumn("d", K.signed_distance("x", "y", "edges"))
        .groupBy(*keys, "measure")
        .agg(F.min(F.abs("d")).alias("distance"))
    )
