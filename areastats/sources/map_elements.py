"""Map elements: nodes and ways with tags."""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from areastats.functions.grid import add_grid, lonlat_to_grid_array
from areastats.sources.scratch import stored
from areastats.sources.schemas import ELEMENT_SCHEMA, MAP_RESPONSE_SCHEMA

MIN_POLYGON_NODES = 4
#: No degree of latitude, and no degree of longitude at the equator, is shorter than this.
METRES_PER_DEGREE_LEAST = 110_000


def read_map_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response documents ({"elements": [...]}), one document per file, many files per folder.

    Each document is one row of one task; `read_large_map_responses` splits them.
    """
    docs = spark.read.schema(MAP_RESPONSE_SCHEMA).option("multiLine", True).json(path)
    return docs.select(F.inline("elements"))


def read_large_map_responses(spark: SparkSession, path: str) -> DataFrame:
    """As `read_map_responses`, for documents of any size: many tasks read one document, at any byte range.

    Files are read as pieces that end with a closing brace. Whether a piece starts within a string, and how
    deep, follows from what comes before it: running sums within a block of the file for both
    possible starts of the block, and sums over the few blocks of each file settle which it is. Pieces are then
    put together by the number of their element. Objects below the root that are no list items (such as
    a header) are left out, and so are items without a type. The pieces are stored once, so that lost tasks read the same ones again.
    """
    pieces = (
        spark.read.option("lineSep", "}").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")
        .select("*", *[c.alias(n) for n, c in _brackets(F.col("value")).items()])
    )
    placed = _placed(stored(pieces))
    joined = placed.filter("depth > 0").groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts")
    )
    text = F.concat(F.array_join(F.col("parts.value"), "}"), F.lit("}"))
    # the first element follows the root's own brace
    text = F.when(F.col("element") == 0, F.regexp_replace(text, _TO_BRACE + r"\{", "")).otherwise(text)
    body = F.regexp_replace("text", _TO_BRACE, "")
    item = ~F.regexp_extract("text", _TO_BRACE, 0).rlike(r":\s*$")
    parsed = joined.select(text.alias("text")).filter(item).select(F.from_json(body, ELEMENT_SCHEMA).alias("e"))
    return parsed.select("e.*").filter(F.col("type").isNotNull())


#: Everything up to the first brace that is not part of a string.
_TO_BRACE = r'^(?:[^{"]++|"(?:[^"\\]++|\\.)*+")*+'


def _brackets(text: Column) -> dict[str, Column]:
    """Quotes of a piece, and its opening braces outside strings if it starts outside (open_0) or within (open_1) one."""
    plain = F.split(F.regexp_replace(text, r"(?s)\\.", ""), '"')

    def opened(parity: int) -> Column:
        outside = F.filter(plain, lambda _, i: i % 2 == parity)
        return F.aggregate(outside, F.lit(0).cast("long"), lambda n, part: n + F.length(part) - F.length(F.replace(part, F.lit("{"), F.lit(""))))

    return {"quotes": (F.size(plain) - 1).cast("long"), "open_0": opened(0), "open_1": opened(1)}


def _placed(pieces: DataFrame) -> DataFrame:
    """Pieces with the depth after their closing brace and the number of their element in the file.

    Only one row per block and file meets in a window over a file.
    """
    block = Window.partitionBy("file", "block").orderBy("seq")
    before, upto = block.rowsBetween(Window.unboundedPreceding, -1), block.rowsBetween(Window.unboundedPreceding, 0)
    sums = pieces.withColumn("_odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for start in (0, 1):
        inside = (F.col("_odd") + start) % 2
        closed = F.when((inside + F.col("quotes")) % 2 == 0, 1).otherwise(0)
        sums = sums.withColumn(f"closes_{start}", closed).withColumn(f"step_{start}", F.when(inside == 0, F.col("open_0")).otherwise(F.col("open_1")) - closed)
    blocks = sums.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), *[F.sum(f"step_{s}").alias(f"step_{s}") for s in (0, 1)])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = blocks.withColumn("start", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    started = started.withColumn("_step", F.when(F.col("start") == 0, F.col("step_0")).otherwise(F.col("step_1")))
    started = started.select("file", "block", "start", F.coalesce(F.sum("_step").over(earlier), F.lit(0)).alias("_base"))
    chosen = lambda name: F.when(F.col("start") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))
    known = sums.join(started, ["file", "block"]).select("file", "block", "seq", "value", "_base", chosen("step").alias("_step"), chosen("closes").alias("_closes"))
    deep = known.withColumn("depth", F.col("_base") + F.sum("_step").over(upto))
    # an element ends where its closing brace leads back to the root
    ends = deep.withColumn("_end", F.when((F.col("depth") == 1) & (F.col("_closes") == 1), 1).otherwise(0))
    passed = ends.groupBy("file", "block").agg(F.sum("_end").alias("_ends"))
    passed = passed.select("file", "block", F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("_passed"))
    number = F.col("_passed") + F.coalesce(F.sum("_end").over(before), F.lit(0))
    return ends.join(passed, ["file", "block"]).select("file", "block", "seq", "value", "depth", number.alias("element"))


def read_map_element_lines(spark: SparkSession, path: str) -> DataFrame:
    """One element per line: the landing form for large areas, since such files split."""
    return spark.read.schema(ELEMENT_SCHEMA).json(path)


def parse_elements(df: DataFrame, payload: Column) -> DataFrame:
    """JSON text of a response per row -> one typed element per row."""
    return df.select(F.inline(F.from_json(payload, MAP_RESPONSE_SCHEMA)["elements"]))


def split_elements(elements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points, polygons, lines): nodes; ways without a highway tag and with at least four
    nodes; ways with a highway tag. Shorter untagged ways belong to none."""
    highway = F.coalesce(F.map_contains_key("tags", "highway"), F.lit(False))
    way = F.col("type") == "way"
    nodes = F.coalesce(F.size("geometry"), F.lit(0))
    points = elements.filter(F.col("type") == "node").select("id", "tags", "lon", "lat")
    polygons = elements.filter(way & ~highway & (nodes >= MIN_POLYGON_NODES)).select("id", "tags", "geometry")
    lines = elements.filter(way & highway).select("id", "tags", "geometry")
    return points, polygons, lines


def near_boxes(elements: DataFrame, boxes: DataFrame, buffer_m: float = 0, nodes: bool = True) -> DataFrame:
    """Elements that may meet a box of degrees (see `areas.district_bbox`) widened by buffer_m, before anything is projected.

    A way counts by its bounding box, since it may cross or enclose a box without a node inside.
    Without `nodes` only ways are tested and every node stays: the nearest point of an area may lie
    at any distance. One small row per district reaches the driver and becomes a condition on each element.
    """
    sides = ("min_lon", "min_lat", "max_lon", "max_lat")
    listed = [_widened(*r, buffer_m) for r in boxes.select(*sides).collect()]
    if not listed:
        return elements.filter(F.lit(False) if nodes else F.col("type") == "node")
    known = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(sides, box, strict=True)]) for box in listed])

    def meets(low_lon: Column, low_lat: Column, high_lon: Column, high_lat: Column) -> Column:
        return F.exists(known, lambda b: (low_lon <= b["max_lon"]) & (high_lon >= b["min_lon"]) & (low_lat <= b["max_lat"]) & (high_lat >= b["min_lat"]))

    node = meets(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat")) if nodes else F.lit(True)
    lon, lat = F.col("geometry.lon"), F.col("geometry.lat")
    way = meets(F.array_min(lon), F.array_min(lat), F.array_max(lon), F.array_max(lat))
    return elements.filter(F.coalesce(F.when(F.col("type") == "node", node).otherwise(way), F.lit(False)))


def _widened(min_lon: float, min_lat: float, max_lon: float, max_lat: float, buffer_m: float) -> tuple[float, ...]:
    """The box with at least buffer_m more on each side; degrees of longitude are shorter further from the equator."""
    lat = buffer_m / METRES_PER_DEGREE_LEAST
    farthest = min(89.0, max(abs(min_lat), abs(max_lat)) + lat)
    lon = lat / math.cos(math.radians(farthest))
    return min_lon - lon, min_lat - lat, max_lon + lon, max_lat + lat


def points_to_grid(points: DataFrame) -> DataFrame:
    return add_grid(points).select("id", "tags", "x", "y")


def ways_to_grid(ways: DataFrame) -> DataFrame:
    """Adds `ring`: the way's nodes in metres."""
    return ways.select("id", "tags", lonlat_to_grid_array(F.col("geometry")).alias("ring"))
