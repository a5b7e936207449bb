"""Map features per area: counts in buffers, nearest distances, ratios, land use, street lighting.

Points meet areas in three steps, so that work follows the number of *places* and not
the number of rows:

1. Points are counted per (location, measures). Copies at one spot collapse map-side.
2. Locations are counted per tile. The tiles of a block meet the areas in reach of it as one row
   (`outline`), which brings the edges that matter to the block. A tile's signed distance to an area
   (negative inside), plus or minus the tile's half diagonal, settles its distance band for all
   its points at once when both ends fall in the same band. A block holds a bounded number
   of tiles, so no block is hot.
3. Only tiles that straddle a band edge are opened: their locations join on the tile
   and are measured against the few edges that can be nearest to that tile.

Counts, ratios and nearest distances read one table of such pairs (`meet`); the names of their measures
start with the family. `measures` is an array of names a point counts towards. Areas come from
`areas.with_edges`; `keys` are their key columns.
"""

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from areastats.constants import AMENITY_GROUPS, BUFFER_DISTANCES, NEAREST_POI, RATIO_DISTANCES, RATIO_PAIRS
from areastats.functions import geometry as G, kernels as K
from areastats.functions.parallel import shared, spread
from areastats.functions.tags import count_groups, nearest_pois, ratio_groups
from areastats.operators.areas import BOX, cover, meeting_pairs
from areastats.operators.outline import outline_index
from areastats.operators.pyramid import farther
from areastats.sources.scratch import shared_folder, stored

KEYS = ("lsoa_code",)
TILE = 250.0
CELL = 1000.0
SLACK = 1e-6  # metres added to bounds that prune, never to a result


# ---------------------------------------------------------------- points


def locations(points: DataFrame, tile: float = TILE) -> DataFrame:
    """Points (x, y, measures) -> one row per distinct (x, y, measures) with its count and tile."""
    return (
        shared(points.filter(F.size("measures") > 0).groupBy("x", "y", "measures").agg(F.count("*").alias("n")))
        .withColumn("tx", F.floor(F.col("x") / tile).cast("long"))
        .withColumn("ty", F.floor(F.col("y") / tile).cast("long"))
    )


def tiles(places: DataFrame) -> DataFrame:
    """Locations -> one row per tile: count per measure (as many as there are measures), centre, half diagonal."""
    per_measure = places.select("tx", "ty", "x", "y", "n", F.explode("measures").alias("measure")).groupBy(
        "tx", "ty", "measure"
    ).agg(
        F.sum("n").alias("n"), F.min("x").alias("minx"), F.min("y").alias("miny"),
        F.max("x").alias("maxx"), F.max("y").alias("maxy"),
    )
    wide, high = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    per_tile = per_measure.groupBy("tx", "ty").agg(
        F.collect_list(F.struct("measure", "n")).alias("counts"),
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
    )
    return (
        shared(per_tile)
        .withColumn("cx", (F.col("minx") + F.col("maxx")) / 2)
        .withColumn("cy", (F.col("miny") + F.col("maxy")) / 2)
        # A tile whose points share one spot is exact; others get a hair of slack.
        .withColumn("half", F.when((wide == 0) & (high == 0), 0.0).otherwise(F.sqrt(wide * wide + high * high) / 2 + SLACK))
    )


class Meeting(NamedTuple):
    """Places and the areas they may count for; `pairs` has one row per (area, tile) in reach."""

    places: DataFrame
    tile_rows: DataFrame
    index: DataFrame
    pairs: DataFrame
    distances: Sequence[float]
    reach: float


def meet(
    areas: DataFrame,
    places: DataFrame,
    distances: Sequence[float],
    keys: Sequence[str] = KEYS,
    tile: float = TILE,
    reach: float | None = None,
    keep: bool = False,
) -> Meeting:
    """Tiles of places and areas within `reach` (the last distance), with s = signed distance of the tile's centre.

    With `keep`, the pairs are stored, for more than one family of measures to read.
    """
    keys = list(keys)
    reach = float(max(distances) if reach is None else reach)
    block_tiles = max(1, math.ceil(max(reach, CELL) / tile))
    tile_rows = tiles(places)
    blocks = (
        tile_rows.withColumn("bx", F.floor(F.col("tx") / block_tiles).cast("long"))
        .withColumn("by", F.floor(F.col("ty") / block_tiles).cast("long"))
        .groupBy("bx", "by").agg(F.collect_list(F.struct("tx", "ty", "cx", "cy", "half")).alias("tiles"))
    )
    index = shared(outline_index(areas, keys, block_tiles * tile, reach))
    measured = K.measured_tiles(
        F.col("tiles"), F.col("near"), F.col("rx"), F.col("ry"), F.col("inside"), [F.col(b) for b in BOX], distances, reach
    )
    pairs = (
        spread(blocks, "bx", "by").join(index, ["bx", "by"])
        # explode(array(..)) keeps the optimizer from copying a costly expression to every place that uses it
        .select(*keys, "bx", "by", "tiles", F.explode(F.array(measured)).alias("measured"))
        .select(*keys, "bx", "by", F.inline(F.arrays_zip("tiles", "measured")))
        .select(*keys, "bx", "by", "tiles.*", "measured.*")
        .filter(F.col("s") - F.col("half") <= reach)
    )
    return Meeting(places, tile_rows, index, stored(pairs) if keep else pairs, distances, reach)


def _band(distance: Column, distances: Sequence[float]) -> Column:
    """Index of the smallest buffer that holds a signed distance; null beyond the last."""
    band = F.when(distance < distances[0], 0)
    for i, d in enumerate(distances[1:], start=1):
        band = band.when(distance < d, i)
    return band


def _of(name: Column, family: str) -> Column:
    return name.startswith(family)


def _prefixed(family: str, names: Column) -> Column:
    return F.transform(names, lambda m: F.concat(F.lit(family), m))


def bands(met: Meeting, family: str = "", keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, measure, band, n): points per smallest buffer they are within, for measures that start with `family`."""
    low, high = _band(F.col("s") - F.col("half"), met.distances), _band(F.col("s") + F.col("half"), met.distances)
    split = F.when(low.eqNullSafe(high), 0).otherwise(1)
    settled = met.pairs.filter(low.isNotNull()).select(
        *keys, "tx", "ty", "cx", "cy", "inside", "near", low.alias("low"), split.alias("open")
    )
    # A settled tile meets its own counts, an open one its locations. An inner join, so
    # that AQE may split a hot tile on the side of the locations.
    none = F.lit(None).cast("double")
    named = F.filter("measures", lambda m: _of(m, family))
    content = met.places.select(
        "tx", "ty", F.lit(1).alias("open"), "x", "y",
        F.transform(named, lambda m: F.struct(m.alias("measure"), F.col("n").alias("n"))).alias("items"),
    ).unionByName(met.tile_rows.select(
        "tx", "ty", F.lit(0).alias("open"), none.alias("x"), none.alias("y"), F.filter("counts", lambda c: _of(c["measure"], family)).alias("items")
    )).filter(F.size("items") > 0)
    band = F.when(F.col("open") == 0, F.col("low")).otherwise(_band(F.col("d"), met.distances))
    items = (
        settled.join(content, ["tx", "ty", "open"])
        .select(*keys, "open", "low", "items", F.explode(F.array(K.signed_from("x", "y", "near", "cx", "cy", "inside"))).alias("d"))
        .select(*keys, band.alias("band"), "items")
        .filter(F.col("band").isNotNull())
    )
    return items.select(*keys, "band", F.inline("items")).groupBy(*keys, "measure", "band").agg(F.sum("n").alias("n"))


def point_bands(
    areas: DataFrame, places: DataFrame, distances: Sequence[float], keys: Sequence[str] = KEYS, tile: float = TILE
) -> DataFrame:
    """`bands` of places on their own."""
    return bands(meet(areas, places, distances, keys, tile), "", keys)


# ---------------------------------------------------------------- polygons in buffers


def polygon_bands(
    areas: DataFrame,
    polygons: DataFrame,
    distances: Sequence[float],
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """(keys, measure, band, n): polygons (ring, measures) per smallest buffer they lie within.

    A polygon lies within a buffer when its farthest point does. For a convex area that
    point is a vertex. Otherwise vertices give a lower and edge lengths an upper bound;
    only where these fall in different bands are edges halved until the band is known, down to
    a centimetre.
    Within the area itself additionally no edges may cross. Copies of a polygon collapse
    first, and every polygon meets areas only in the block of its first vertex.
    """
    reach = float(max(distances))
    cell = max(reach, TILE)
    shape = F.col("shape")
    corners = F.transform(shape, lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y")))
    longest = F.array_max(F.transform(shape, lambda e: F.sqrt(
        (e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"])
    )))
    copies = polygons.filter(F.size("measures") > 0).groupBy("ring", "measures").agg(F.count("*").alias("copies"))
    shapes = (
        spread(copies, "ring")
        .select("measures", "copies", F.explode(F.array(G.ring_edges(F.col("ring")))).alias("shape"))
        .select(
            "measures", "copies", "shape", corners.alias("corners"), (longest / 2).alias("half"),
            *[c.alias(f"p_{n}") for n, c in G.bounds(shape).items()],
        )
        .withColumn("bx", F.floor(F.col("shape")[0]["x1"] / cell).cast("long"))
        .withColumn("by", F.floor(F.col("shape")[0]["y1"] / cell).cast("long"))
    )
    blocks = cover(areas.select(*keys, "edges", "convex", *BOX), cell, reach + SLACK)
    held = (
        (F.col("p_minx") >= F.col("minx") - reach) & (F.col("p_maxx") <= F.col("maxx") + reach)
        & (F.col("p_miny") >= F.col("miny") - reach) & (F.col("p_maxy") <= F.col("maxy") + reach)
    )

    def band_of(distance: Column) -> Column:
        band = F.when(distance <= distances[0] + (SLACK if distances[0] == 0 else 0), 0)
        for i, d in enumerate(distances[1:], start=1):
            band = band.when(distance <= d, i)
        return band

    pairs = (
        shapes.join(blocks, ["bx", "by"]).filter(held)
        .select(
            *keys, "measures", "copies", "edges", "shape", "half", "convex",
            F.explode(F.array(K.farthest("corners", "edges"))).alias("v"),
        )
        .filter(F.col("v") <= reach + SLACK)
    )
    settled = F.col("convex") | band_of(F.col("v")).eqNullSafe(band_of(F.col("v") + F.col("half")))
    # Kernels run on every row, so rows that need no second look hand them nulls.
    outline = F.when(~settled, shape)
    positive = [d for d in distances if d > 0]
    inner = F.when(~F.col("convex") & (F.col("v") <= SLACK), shape)
    far = (
        pairs.select(*keys, "measures", "copies", "v", "edges", F.inline(F.array(F.struct(inner.alias("inner"), outline.alias("outline")))))
        .select(*keys, "measures", "copies", "v", "edges", "inner", F.explode(F.array(K.farthest_along(F.col("outline"), F.col("edges"), positive))).alias("along"))
        .select(*keys, "measures", "copies", F.greatest("v", F.coalesce("along", "v")).alias("far"), F.explode(F.array(K.leaves("inner", "edges"))).alias("leaves"))
    )
    beyond = [i for i, d in enumerate(distances) if d > 0]
    outside = F.lit(beyond[0]) if beyond else F.lit(None).cast("int")
    band = F.when((F.col("far") <= SLACK) & F.col("leaves"), outside).otherwise(band_of(F.col("far")))
    return (
        far.select(*keys, "measures", "copies", F.explode(F.array(band)).alias("band"))
        .filter(F.col("band").isNotNull())
        .select(*keys, "band", "copies", F.explode("measures").alias("measure"))
        .groupBy(*keys, "measure", "band")
        .agg(F.sum("copies").alias("n"))
    )


# ---------------------------------------------------------------- counts and ratios


def _within(counted: DataFrame, distances: Sequence[float], keys: Sequence[str], wanted: Sequence[float] | None = None) -> DataFrame:
    """Bands -> one row per (keys, measure) with the count within each distance, n_{d}."""
    return counted.groupBy(*keys, "measure").agg(*[
        F.sum(F.when(F.col("band") <= list(distances).index(d), F.col("n")).otherwise(F.lit(0))).alias(f"n_{d}") for d in wanted or distances
    ])


def poi_counts_long(
    areas: DataFrame,
    points: DataFrame,
    polygons: DataFrame | None = None,
    groups: dict[str, list[str]] = AMENITY_GROUPS,
    distances: Sequence[int] = BUFFER_DISTANCES,
    keys: Sequence[str] = KEYS,
    tile: float = TILE,
) -> DataFrame:
    """(keys, measure, n_{d}...) for points (x, y, tags) and polygons (ring, tags).

    An element counts once per group however many of its tags match. Groups without any
    element in reach have no row.
    """
    tagged = points.select("x", "y", count_groups(F.col("tags"), groups).alias("measures"))
    counted = point_bands(areas, locations(tagged, tile), distances, keys, tile)
    if polygons is not None:
        shapes = polygons.select("ring", count_groups(F.col("tags"), groups).alias("measures"))
        counted = counted.unionByName(polygon_bands(areas, shapes, distances, keys))
    return _within(counted, distances, keys)


def widen_counts(
    counts: DataFrame, groups: Sequence[str], distances: Sequence[int], keys: Sequence[str] = KEYS
) -> DataFrame:
    """count_{group}_{d} columns; the pivot comes last, over rows that are already one per group."""
    wide = counts.groupBy(*keys).pivot("measure", list(groups)).agg(*[
        F.first(f"n_{d}").alias(f"n_{d}") for d in distances
    ])
    source = "`{g}_n_{d}`" if len(distances) > 1 else "`{g}`"
    return wide.selectExpr(*keys, *[
        f"coalesce({source.format(g=g, d=d)}, 0) AS `count_{g}_{d}`" for g in groups for d in distances
    ])


def poi_counts(
    areas: DataFrame,
    points: DataFrame,
    polygons: DataFrame | None = None,
    groups: dict[str, list[str]] = AMENITY_GROUPS,
    distances: Sequence[int] = BUFFER_DISTANCES,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """count_{group}_{d} for every area, 0 where nothing is in reach."""
    counts = poi_counts_long(areas, points, polygons, groups, distances, keys)
    wide = widen_counts(counts, list(groups), distances, keys)
    return areas.select(*keys).join(wide, list(keys), "left").fillna(0)


def poi_ratios(
    areas: DataFrame,
    points: DataFrame,
    groups: dict[str, list[str]] = AMENITY_GROUPS,
    pairs: Sequence[tuple[str, str]] = RATIO_PAIRS,
    distances: Sequence[int] = RATIO_DISTANCES,
    keys: Sequence[str] = KEYS,
    tile: float = TILE,
) -> DataFrame:
    """ratio_{num}_to_{den}_{d}; null where the denominator is 0."""
    used = {g: groups.get(g, []) for pair in pairs for g in pair}
    tagged = points.select("x", "y", ratio_groups(F.col("tags"), used).alias("measures"))
    counted = point_bands(areas, locations(tagged, tile), distances, keys, tile)
    return _ratios(_within(counted, distances, keys), pairs, distances, keys)


def _ratios(counts: DataFrame, pairs: Sequence[tuple[str, str]], distances: Sequence[int], keys: Sequence[str]) -> DataFrame:
    wide = widen_counts(counts, list({g: None for pair in pairs for g in pair}), distances, keys)
    return wide.selectExpr(*keys, *[
        f"try_divide(double(`count_{a}_{d}`), double(`count_{b}_{d}`)) AS `ratio_{a}_to_{b}_{d}`"
        for a, b in pairs for d in distances
    ])


# ---------------------------------------------------------------- nearest


def _closest(met: Meeting, keys: Sequence[str], family: str) -> DataFrame:
    """Exact least distance per (keys, measure) of the places in reach.

    Only tiles whose nearest possible point beats the best farthest possible one are opened; what is
    shuffled to find them holds no geometry. The few that stay fetch their edges by block.
    """
    keys = list(keys)
    low = F.greatest(F.col("s") - F.col("half"), F.lit(0.0))
    high = F.greatest(F.col("s") + F.col("half"), F.lit(0.0))
    group = Window.partitionBy(*keys, "measure")
    named = met.tile_rows.select("tx", "ty", F.explode(F.filter(F.col("counts.measure"), lambda m: _of(m, family))).alias("measure"))
    kept = shared(
        met.pairs.select(*keys, "bx", "by", "tx", "ty", "cx", "cy", "half", "s", "inside")
        .join(named, ["tx", "ty"])
        .withColumn("_best", F.min(high).over(group))
        .filter(low <= F.col("_best"))
        .groupBy(*keys, "bx", "by", "tx", "ty", "cx", "cy", "half", "s", "inside").agg(F.collect_list("measure").alias("measures"))
    )
    opened = (
        kept.groupBy(*keys, "bx", "by").agg(F.collect_list(F.struct("tx", "ty", "cx", "cy", "half", "s", "inside", "measures")).alias("tiles"))
        .join(met.index.select(*keys, "bx", "by", "near"), [*keys, "bx", "by"])
        .select(*keys, "tiles", F.explode(F.array(K.tile_edges("tiles", "near"))).alias("near"))
        .select(*keys, F.inline(F.arrays_zip("tiles", "near")))
        .select(*keys, "tiles.*", "near")
        .withColumn("measure", F.explode("measures"))
    )
    inner = met.places.select("tx", "ty", "x", "y", F.explode(F.filter("measures", lambda m: _of(m, family))).alias("measure"))
    exact = F.when(F.col("s") + F.col("half") <= 0, 0.0).otherwise(F.greatest(F.col("d"), F.lit(0.0)))
    return (
        opened.join(inner, ["tx", "ty", "measure"])
        .withColumn("d", K.signed_from("x", "y", "near", "cx", "cy", "inside"))
        .groupBy(*keys, "measure")
        .agg(F.min(exact).alias("distance"))
    )


def nearest_of(
    areas: DataFrame, met: Meeting, pois: Sequence[str], keys: Sequence[str] = KEYS, tile: float = TILE, family: str = ""
) -> DataFrame:
    """(keys, measure, distance) of a meeting whose pairs are stored; those without a place in reach search on."""
    found = stored(_closest(met, keys, family).filter(F.col("distance") <= met.reach))
    wanted = areas.select(*keys, F.explode(F.array(*[F.lit(family + p) for p in pois])).alias("measure"))
    missing = wanted.join(found, [*keys, "measure"], "left_anti")
    named = met.tile_rows.select(
        F.explode(F.filter(F.col("counts.measure"), lambda m: _of(m, family))).alias("measure"), F.col("tx").alias("gx"), F.col("ty").alias("gy"), *BOX
    )
    tile_places = met.places.select("tx", "ty", "x", "y", F.explode(F.filter("measures", lambda m: _of(m, family))).alias("measure"))
    return found.unionByName(farther(areas, missing, named, tile_places, keys, tile))


def poi_nearest_long(
    areas: DataFrame,
    points: DataFrame,
    pois: Sequence[str] = NEAREST_POI,
    keys: Sequence[str] = KEYS,
    reach: float = 5000.0,
    tile: float = TILE,
) -> DataFrame:
    """(keys, measure, distance): from each area to the nearest point of each poi, 0 inside.

    Areas with a poi within `reach` are settled first; for the others a search from the top of a pyramid
    of cells finds every poi that exists.
    """
    tagged = points.select("x", "y", nearest_pois(F.col("tags"), pois).alias("measures"))
    return nearest_of(areas, meet(areas, locations(tagged, tile), [], keys, tile, reach, keep=True), pois, keys, tile)


def poi_nearest(
    areas: DataFrame, points: DataFrame, pois: Sequence[str] = NEAREST_POI, keys: Sequence[str] = KEYS, **options
) -> DataFrame:
    """nearest_{poi} columns; null where the poi does not exist."""
    return _widen_nearest(poi_nearest_long(areas, points, pois, keys, **options), pois, keys)


def _widen_nearest(long: DataFrame, pois: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("measure") == p, F.col("distance"))).alias(f"nearest_{p}") for p in pois
    ])


# ---------------------------------------------------------------- land use and lighting


def landuse_long(
    areas: DataFrame, polygons: DataFrame, keys: Sequence[str] = KEYS, cell: float = CELL
) -> DataFrame:
    """(keys, landuse, share): overlap of each land-use type / area of the area. Overlaps count twice."""
    parcels = (
        polygons.select(F.try_element_at("tags", F.lit("landuse")).alias("landuse"), "ring")
        .filter(F.col("landuse").isNotNull())
        .select("landuse", F.explode(F.array(G.ring_edges(F.col("ring")))).alias("shape"))
        .select("landuse", "shape", *[c.alias(n) for n, c in G.bounds(F.col("shape")).items()])
    )
    pairs = meeting_pairs(parcels, areas.select(*keys, "edges", "area", *BOX), cell)
    return (
        pairs.select(*keys, "landuse", "area", F.explode(F.array(K.overlap_area("edges", "shape"))).alias("overlap"))
        .filter(F.col("overlap") > 0)
        .groupBy(*keys, "landuse")
        .agg(F.sum("overlap").alias("overlap"), F.first("area").alias("area"))
        .select(*keys, "landuse", F.try_divide("overlap", "area").alias("share"))
    )


def landuse_shares(
    areas: DataFrame,
    polygons: DataFrame,
    types: Sequence[str] | None = None,
    keys: Sequence[str] = KEYS,
    cell: float = CELL,
) -> DataFrame:
    """landuse_{type}_0 for every area, 0 where absent.

    With `types`, the shares of all other types are summed in landuse_unlisted_0. Without, the pivot
    first reads the distinct types, at most spark.sql.pivotMaxValues of them, from the stored
    shares; name them for a stable schema and no extra job.
    """
    long = landuse_long(areas, polygons, keys, cell)
    if types is None:
        folder = shared_folder(areas.sparkSession)
        long.write.parquet(folder)
        long = areas.sparkSession.read.schema(long.schema).parquet(folder)
        pivoted = long.groupBy(*keys).pivot("landuse").agg(F.sum("share"))
    else:
        named = F.when(F.col("landuse").isin(list(types)), F.col("landuse")).otherwise("unlisted")
        pivoted = long.withColumn("landuse", named).groupBy(*keys).pivot("landuse", [*types, "unlisted"]).agg(F.sum("share"))
    named = pivoted.withColumnsRenamed({c: f"landuse_{c}_0" for c in pivoted.columns if c not in keys})
    return areas.select(*keys).join(named, list(keys), "left").fillna(0)


def streetlit_share(areas: DataFrame, lines: DataFrame, keys: Sequence[str] = KEYS, cell: float = CELL) -> DataFrame:
    """streetlit_percentage: length of lines tagged lit=yes / length of all lines, inside the area."""
    paths = (
        lines.select((F.try_element_at("tags", F.lit("lit")) == "yes").alias("lit"), F.explode(F.array(G.path_edges(F.col("ring")))).alias("path"))
        .filter(F.size("path") > 0)
        .select(F.coalesce("lit", F.lit(False)).alias("lit"), "path", *[c.alias(n) for n, c in G.bounds(F.col("path")).items()])
    )
    pairs = meeting_pairs(paths, areas.select(*keys, "edges", *BOX), cell)
    clipped = pairs.select(*keys, "lit", F.explode(F.array(K.clipped_length("path", "edges"))).alias("length")).filter(F.col("length") > 0)
    lit = F.coalesce(F.sum(F.when(F.col("lit"), F.col("length"))), F.lit(0.0))
    return clipped.groupBy(*keys).agg(F.try_divide(lit, F.sum("length")).alias("streetlit_percentage"))


# ---------------------------------------------------------------- all map features


def map_features(
    areas: DataFrame,
    points: DataFrame,
    polygons: DataFrame,
    lines: DataFrame,
    keys: Sequence[str] = KEYS,
    groups: dict[str, list[str]] = AMENITY_GROUPS,
    pois: Sequence[str] = NEAREST_POI,
    pairs: Sequence[tuple[str, str]] = RATIO_PAIRS,
    landuse_types: Sequence[str] | None = None,
) -> DataFrame:
    """Every map feature side by side on the areas; geometry is dropped.

    Counts, ratios and nearest distances come from one scan of the points, whose distinct places are
    stored, one table of tiles and one stored table of (area, tile) pairs; counts and ratios share one pass over its bands.
    """
    used = {g: groups.get(g, []) for pair in pairs for g in pair}
    tags = F.col("tags")
    families = {"count:": count_groups(tags, groups), "ratio:": ratio_groups(tags, used), "nearest:": nearest_pois(tags, pois)}
    named = [_prefixed(f, names) for f, names in families.items()]
    distances = sorted({*BUFFER_DISTANCES, *RATIO_DISTANCES})
    # explode(array(..)): the names of a point are made once, not again for the filter of `locations`
    places = stored(locations(points.select("x", "y", F.explode(F.array(F.concat(*named))).alias("measures"))))
    met = meet(areas, places, distances, keys, keep=True)
    shapes = polygons.select("ring", _prefixed("count:", count_groups(tags, groups)).alias("measures"))
    counted = bands(met, "", keys).filter(~_of(F.col("measure"), "nearest:")).unionByName(polygon_bands(areas, shapes, distances, keys))
    counts = stored(_within(counted, distances, keys))

    def family(name: str, rows: DataFrame) -> DataFrame:
        return rows.filter(_of(F.col("measure"), name)).withColumn("measure", F.substring("measure", len(name) + 1, 1000))

    out = areas.select(*keys)
    for part in (
        areas.select(*keys).join(widen_counts(family("count:", counts), list(groups), BUFFER_DISTANCES, keys), list(keys), "left").fillna(0),
        _widen_nearest(family("nearest:", nearest_of(areas, met, pois, keys, family="nearest:")), pois, keys),
        _ratios(family("ratio:", counts), pairs, RATIO_DISTANCES, keys),
        landuse_shares(areas, polygons, landuse_types, keys),
        streetlit_share(areas, lines, keys),
    ):
        out = out.join(part, list(keys), "left")
    return out
