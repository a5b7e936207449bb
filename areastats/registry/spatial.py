"""Queries on map elements and boundaries."""

from pyspark.sql import functions as F

from areastats import constants as C
from areastats.functions.grid import add_grid
from areastats.functions.tags import nearest_pois
from areastats.operators import areas as area_ops, spatial
from areastats.registry.base import query, rounded
from areastats.sources import map_elements
from areastats.sources.scratch import shared_folder

KEY = ["lsoa_code"]
POLYGON_GROUPS = {"economy": ["ECONOMY"], "retail": ["LARGE", "PROMO"], "mixed": ["PROMO", "SMALL"]}
LANDUSE_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]  # STANDARD stays unlisted


def _xy(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


def _square(x0, y0, side):
    """Ring of a square, unclosed."""
    x1, y1 = x0 + side, y0 + side
    return F.array(_xy(x0, y0), _xy(x1, y0), _xy(x1, y1), _xy(x0, y1))


def _boundaries(t):
    ring = _square(F.col("x0"), F.col("y0"), F.col("side"))
    return t.v_area.select(F.col("area_code").alias("lsoa_code"), F.array(F.array(ring)).alias("polygons"))


def _areas(t):
    return area_ops.with_edges(_boundaries(t), KEY)


def _points(t):
    return t.v_points.select("id", "x", "y", F.create_map(F.lit("amenity"), F.col("amenity")).alias("tags"))


def _parcels(t):
    ring = _square(F.col("x0"), F.col("y0"), F.col("side"))
    return t.v_landuse.select("id", F.create_map(F.lit("landuse"), F.col("landuse")).alias("tags"), ring.alias("ring"))


def _lines(t):
    path = F.array(_xy(F.col("x1"), F.col("y1")), _xy(F.col("x1") + F.col("dx"), F.col("y1") + F.col("dy")))
    tags = F.create_map(F.lit("highway"), F.lit("path"), F.lit("lit"), F.col("lit"))
    return t.v_lines.select("id", tags.alias("tags"), path.alias("ring"))


_GAP = "sqrt(pow(greatest(x0 - x, 0, x - x0 - side), 2) + pow(greatest(y0 - y, 0, y - y0 - side), 2))"
_DIST = f"d AS (SELECT a.area_code AS lsoa_code, p.id, p.amenity, {_GAP} AS dist FROM v_area a, v_points p)"


def _within(d):
    return "dist = 0" if d == 0 else f"dist < {d}"


def _in(column, words):
    return f"{column} IN (" + ", ".join(f"'{w}'" for w in words) + ")"


def _count_columns(groups, column, source_within=_within):
    return ", ".join(
        f"CAST(count(*) FILTER ({_in(column, words)} AND {source_within(d)}) AS BIGINT) AS \"count_{g}_{d}\""
        for g, words in groups.items() for d in C.BUFFER_DISTANCES
    )


# ---------------------------------------------------------------- sources


def _element_texts(t):
    node = F.struct(
        F.lit("node").alias("type"), "id", (F.col("x") / 1000).alias("lon"), (F.col("y") / 1000).alias("lat"),
        F.create_map(F.lit("tag"), F.col("amenity")).alias("tags"),
    )
    lonlat = F.array(
        F.struct(F.col("x1").alias("lon"), F.col("y1").alias("lat")),
        F.struct((F.col("x1") + F.col("dx")).alias("lon"), (F.col("y1") + F.col("dy")).alias("lat")),
    )
    way = F.struct(
        F.lit("way").alias("type"), "id", F.create_map(F.lit("tag"), F.lit("path")).alias("tags"), lonlat.alias("geometry")
    )
    return t.v_points.select("id", F.to_json(node).alias("e")).unionByName(t.v_lines.select("id", F.to_json(way).alias("e")))


def _shown(parsed):
    last = F.element_at("geometry", -1)  # ways show their last node
    return parsed.select("type", "id", F.coalesce("lon", last["lon"]).alias("lon"), F.coalesce("lat", last["lat"]).alias("lat"), F.col("tags")["tag"].alias("tag"), F.size("geometry").cast("long").alias("nodes"))


@query("map_elements", """
SELECT 'node' AS type, id, x / 1000 AS lon, y / 1000 AS lat, amenity AS tag, CAST(NULL AS BIGINT) AS nodes FROM v_points
UNION ALL SELECT 'way', id, x1 + dx, y1 + dy, 'path', CAST(2 AS BIGINT) FROM v_lines""")
def _(t):
    docs = _element_texts(t).select(F.concat(F.lit('{"elements":['), "e", F.lit("]}")).alias("payload"))
    return _shown(map_elements.parse_elements(docs, F.col("payload")))


@query("map_documents", """
SELECT 'node' AS type, id, x / 1000 AS lon, y / 1000 AS lat, amenity AS tag, CAST(NULL AS BIGINT) AS nodes FROM v_points
UNION ALL SELECT 'way', id, x1 + dx, y1 + dy, 'path', CAST(2 AS BIGINT) FROM v_lines""")
def _(t):
    """One document per hundred thousand ids, read at byte ranges."""
    folder = shared_folder(t.spark)
    rows = _element_texts(t).select(F.expr("id div 100000").alias("doc"), F.col("id").alias("at"), F.concat("e", F.lit(",")).alias("value"))
    docs = rows.select("doc").distinct()
    head = F.lit('{"version":0.6,"remark":"braces { in \\"text\\"","source":{"a":{"b":"}"}},"elements":[')
    ends = docs.select("doc", F.lit(None).cast("long").alias("at"), head.alias("value")).unionByName(
        docs.select("doc", F.lit(2**62).alias("at"), F.lit('{"type":"way","id":-1}]}').alias("value"))
    )
    rows.unionByName(ends).repartition("doc").sortWithinPartitions("doc", F.asc_nulls_first("at")).drop("at").write.partitionBy("doc").text(folder)
    return _shown(map_elements.read_large_map_responses(t.spark, folder)).filter("id >= 0")


@query("map_split", """
SELECT 'point' AS kind, id FROM v_points UNION ALL SELECT 'polygon', id FROM v_landuse WHERE id % 4 >= 2 UNION ALL SELECT 'line', id FROM v_lines""")
def _(t):
    tag = F.create_map(F.lit("amenity"), F.lit("x"))
    point = F.struct(F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))
    # Ways of two to five nodes: those under four nodes belong to no kind.
    some_nodes = F.array_repeat(point, (F.col("id") % 4 + 2).cast("int"))
    elements = (
        t.v_points.select(F.lit("node").alias("type"), "id", "x", "y", tag.alias("tags"), F.lit(None).cast("array<struct<lon:double,lat:double>>").alias("geometry"))
        .unionByName(t.v_landuse.select(F.lit("way").alias("type"), "id", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), tag.alias("tags"), some_nodes.alias("geometry")))
        .unionByName(t.v_lines.select(
            F.lit("way").alias("type"), "id", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"),
            F.create_map(F.lit("highway"), F.lit("path")).alias("tags"), F.array_repeat(point, 2).alias("geometry")))
        .withColumnsRenamed({"x": "lon", "y": "lat"})
    )
    parts = map_elements.split_elements(elements)
    named = [p.select(F.lit(kind).alias("kind"), "id") for kind, p in zip(("point", "polygon", "line"), parts)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("area_edges", """
SELECT area_code AS lsoa_code, CAST(4 AS BIGINT) AS n_edges, side * side AS area, x0 AS minx, y0 AS miny, x0 + side AS maxx, y0 + side AS maxy, true AS convex FROM v_area""")
def _(t):
    def node(x, y):
        return F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))

    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("side"), y0 + F.col("side")
    ring = F.concat_ws(",", node(x0, y0), node(x0, y1), node(x1, y1), node(x1, y0), node(x0, y0))  # clockwise
    one = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    many = F.concat(F.lit('{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":[[['), ring, F.lit("]]]}}"))
    shape = F.when(F.col("x0") > 3000, many).otherwise(one)
    parsed = t.v_area.select(F.col("area_code").alias("lsoa_code"), area_ops.parse_geojson(shape).alias("polygons"))
    out = area_ops.with_edges(parsed, KEY)
    return out.select("lsoa_code", F.size("edges").cast("long").alias("n_edges"), "area", *area_ops.BOX, "convex")


def _num(value):
    """A double literal: decimals would overflow."""
    return f"CAST({value!r} AS DOUBLE)" if "e" in repr(value) else f"{value!r}e0"


_E2A = _num(1 - (C.WGS84_B / C.WGS84_A) ** 2)
_E2B = _num(1 - (C.AIRY_B / C.AIRY_A) ** 2)
_N = (C.AIRY_A - C.AIRY_B) / (C.AIRY_A + C.AIRY_B)
_SEC = "pi() / 648000"


@query("to_grid", f"""
WITH p AS (SELECT id, radians(49.9 + y / 1000) AS lat, radians(-6 + x / 1250) AS lon FROM v_points),
c AS (SELECT id, {_num(C.WGS84_A)} / sqrt(1 - {_E2A} * pow(sin(lat), 2)) AS nu, lat, lon FROM p),
k AS (SELECT id, nu * cos(lat) * cos(lon) AS x, nu * cos(lat) * sin(lon) AS y, nu * (1 - {_E2A}) * sin(lat) AS z FROM c),
h AS (SELECT id, {_num(C.SHIFT_TX)} + x * (1 + {_num(C.SHIFT_SCALE_PPM)} / 1e6) - y * ({_num(C.SHIFT_RZ_SEC)} * {_SEC}) + z * ({_num(C.SHIFT_RY_SEC)} * {_SEC}) AS x,
  {_num(C.SHIFT_TY)} + x * ({_num(C.SHIFT_RZ_SEC)} * {_SEC}) + y * (1 + {_num(C.SHIFT_SCALE_PPM)} / 1e6) - z * ({_num(C.SHIFT_RX_SEC)} * {_SEC}) AS y,
  {_num(C.SHIFT_TZ)} - x * ({_num(C.SHIFT_RY_SEC)} * {_SEC}) + y * ({_num(C.SHIFT_RX_SEC)} * {_SEC}) + z * (1 + {_num(C.SHIFT_SCALE_PPM)} / 1e6) AS z FROM k),
i0 AS (SELECT id, sqrt(x * x + y * y) AS q, z, atan2(y, x) AS lon, atan2(z, sqrt(x * x + y * y) * (1 - {_E2B})) AS lat FROM h),
i1 AS (SELECT id, q, z, lon, atan2(z + {_E2B} * {_num(C.AIRY_A)} / sqrt(1 - {_E2B} * pow(sin(lat), 2)) * sin(lat), q) AS lat FROM i0),
i2 AS (SELECT id, q, z, lon, atan2(z + {_E2B} * {_num(C.AIRY_A)} / sqrt(1 - {_E2B} * pow(sin(lat), 2)) * sin(lat), q) AS lat FROM i1),
i3 AS (SELECT id, q, z, lon, atan2(z + {_E2B} * {_num(C.AIRY_A)} / sqrt(1 - {_E2B} * pow(sin(lat), 2)) * sin(lat), q) AS lat FROM i2),
s AS (SELECT id, lat, lon - radians({_num(C.GRID_LON0_DEG)}) AS l, {_num(C.AIRY_A)} * {_num(C.GRID_F0)} / sqrt(1 - {_E2B} * pow(sin(lat), 2)) AS nu,
  {_num(C.AIRY_A)} * {_num(C.GRID_F0)} * (1 - {_E2B}) / pow(1 - {_E2B} * pow(sin(lat), 2), 1.5) AS rho, lat - radians({_num(C.GRID_LAT0_DEG)}) AS dm, lat + radians({_num(C.GRID_LAT0_DEG)}) AS dp FROM i3),
m AS (SELECT *, nu / rho - 1 AS eta2, {_num(C.AIRY_B)} * {_num(C.GRID_F0)} * ({_num(1 + _N + 1.25 * _N**2 + 1.25 * _N**3)} * dm - {_num(3 * _N + 3 * _N**2 + 2.625 * _N**3)} * sin(dm) * cos(dp)
  + {_num(1.875 * _N**2 + 1.875 * _N**3)} * sin(2 * dm) * cos(2 * dp) - {_num(35 / 24 * _N**3)} * sin(3 * dm) * cos(3 * dp)) AS arc FROM s)
SELECT id, round({_num(C.GRID_E0)} + nu * cos(lat) * l + nu / 6 * pow(cos(lat), 3) * (nu / rho - pow(tan(lat), 2)) * pow(l, 3)
    + nu / 120 * pow(cos(lat), 5) * (5 - 18 * pow(tan(lat), 2) + pow(tan(lat), 4) + 14 * eta2 - 58 * pow(tan(lat), 2) * eta2) * pow(l, 5), 2) AS east,
  round({_num(C.GRID_N0)} + arc + nu / 2 * sin(lat) * cos(lat) * pow(l, 2) + nu / 24 * sin(lat) * pow(cos(lat), 3) * (5 - pow(tan(lat), 2) + 9 * eta2) * pow(l, 4)
    + nu / 720 * sin(lat) * pow(cos(lat), 5) * (61 - 58 * pow(tan(lat), 2) + pow(tan(lat), 4)) * pow(l, 6), 2) AS north
FROM m""")
def _(t):
    lonlat = t.v_points.select("id", (F.col("x") / 1250 - 6).alias("lon"), (F.col("y") / 1000 + 49.9).alias("lat"))
    grid = add_grid(lonlat).withColumnsRenamed({"x": "east", "y": "north"})
    return rounded(grid.select("id", "east", "north"), 2)


@query("district_bbox", """
SELECT g.lad_name AS district, round(min(y0) - 5000 / 111000, 4) AS min_lat, round(min(x0) - 5000 / 111000, 4) AS min_lon,
  round(max(y0 + side) + 5000 / 111000, 4) AS max_lat, round(max(x0 + side) + 5000 / 111000, 4) AS max_lon
FROM v_area a JOIN (SELECT DISTINCT lad_name, lsoa_code_21 FROM v_geo) g ON a.area_code = g.lsoa_code_21 GROUP BY 1""")
def _(t):
    names = t.v_geo.select(F.col("lad_name").alias("district"), F.col("lsoa_code_21").alias("lsoa_code")).distinct()
    return rounded(area_ops.district_bbox(_areas(t).join(names, "lsoa_code"), buffer_m=5000))


@query("largest_part", """
SELECT id, round(side * side, 4) AS part_area, x0 AS first_x FROM v_landuse""")
def _(t):
    big = _square(F.col("x0"), F.col("y0"), F.col("side"))
    small = _square(F.col("x0") + F.col("side") * 2, F.col("y0"), F.col("side") / 2)
    parts = F.when(F.col("id") % 2 == 0, F.array(F.array(big), F.array(small))).otherwise(F.array(F.array(small), F.array(big)))
    out = area_ops.largest_parts(t.v_landuse.select("id", parts.alias("polygons")), ["id"])
    return rounded(out.select("id", "part_area", F.col("part")[0][0]["x"].alias("first_x")))


@query("tag_match", f"""
SELECT id, amenity AS poi FROM v_points WHERE {_in('amenity', C.NEAREST_POI)}
UNION SELECT id, 'atm' FROM v_points WHERE id % 3 = 0 UNION SELECT id, 'cinema' FROM v_points WHERE id % 5 = 0 UNION SELECT id, 'shop' FROM v_points WHERE id % 5 = 0""")
def _(t):
    tags = F.map_concat(
        F.create_map(F.lit("amenity"), F.col("amenity")),
        F.when(F.col("id") % 3 == 0, F.create_map(F.lit("atm"), F.lit("yes"))).otherwise(F.create_map(F.lit("name"), F.lit("pub"))),
        F.when(F.col("id") % 5 == 0, F.create_map(F.lit("shop"), F.lit("cinema"))).otherwise(F.create_map(F.lit("ref"), F.lit("bank"))),
    )
    return t.v_points.select("id", F.explode(nearest_pois(tags, C.NEAREST_POI)).alias("poi"))


# ---------------------------------------------------------------- features


@query("points_in_area", f"""
WITH {_DIST} SELECT lsoa_code, amenity AS measure, CAST(count(*) AS BIGINT) AS n FROM d WHERE dist = 0 GROUP BY 1, 2""")
def _(t):
    points = t.v_points.select("x", "y", F.array("amenity").alias("measures"))
    return spatial.point_bands(_areas(t), spatial.locations(points), [0]).select("lsoa_code", "measure", "n")


@query("poi_counts", f"WITH {_DIST} SELECT lsoa_code, {_count_columns(C.AMENITY_GROUPS, 'amenity')} FROM d GROUP BY 1")
def _(t):
    return spatial.poi_counts(_areas(t), _points(t))


_CORNER = "sqrt(pow(greatest(x0 - {x}, 0, {x} - x0 - side), 2) + pow(greatest(y0 - {y}, 0, {y} - y0 - side), 2))"
_FARTHEST = "greatest(" + ", ".join(
    _CORNER.format(x=x, y=y) for x in ("px", "(px + ps)") for y in ("py", "(py + ps)")
) + ")"


@query("poi_counts_polygons", f"""
WITH pairs AS (SELECT a.*, l.landuse, l.x0 AS px, l.y0 AS py, l.side AS ps FROM v_area a, v_landuse l),
d AS (SELECT area_code AS lsoa_code, landuse, {_FARTHEST} AS dist FROM pairs)
SELECT lsoa_code, {_count_columns(POLYGON_GROUPS, 'landuse', lambda d: f'dist <= {d}')} FROM d GROUP BY 1""")
def _(t):
    return spatial.poi_counts(_areas(t), _points(t), _parcels(t), groups=POLYGON_GROUPS)


_NEAREST_SQL = ", ".join(
    f"round(CAST(min(dist) FILTER (amenity = '{p}') AS DOUBLE), 4) AS nearest_{p}" for p in C.NEAREST_POI
)


@query("poi_nearest", f"WITH {_DIST} SELECT lsoa_code, {_NEAREST_SQL} FROM d GROUP BY 1")
def _(t):
    return rounded(spatial.poi_nearest(_areas(t), _points(t)))


def _ratio_sql(a, b, d):
    def n(group):
        return f"count(*) FILTER ({_in('amenity', C.AMENITY_GROUPS[group])} AND {_within(d)})"

    return f"round({n(a)} / nullif({n(b)}, 0), 4) AS \"ratio_{a}_to_{b}_{d}\""


_RATIO_SQL = ", ".join(_ratio_sql(a, b, d) for a, b in C.RATIO_PAIRS for d in C.RATIO_DISTANCES)


@query("poi_ratio", f"WITH {_DIST} SELECT lsoa_code, {_RATIO_SQL} FROM d GROUP BY 1")
def _(t):
    return rounded(spatial.poi_ratios(_areas(t), _points(t)))


_OVERLAP = """o AS (SELECT a.area_code AS lsoa_code, l.landuse,
  greatest(least(a.x0 + a.side, l.x0 + l.side) - greatest(a.x0, l.x0), 0) * greatest(least(a.y0 + a.side, l.y0 + l.side) - greatest(a.y0, l.y0), 0) / (a.side * a.side) AS part
  FROM v_area a, v_landuse l)"""
_LANDUSE_SQL = ", ".join(
    f"round(coalesce(sum(part) FILTER (landuse = '{k}'), 0), 4) AS \"landuse_{k}_0\"" for k in LANDUSE_TYPES
) + f""", round(coalesce(sum(part) FILTER (landuse NOT IN ({", ".join(f"'{k}'" for k in LANDUSE_TYPES)})), 0), 4) AS landuse_unlisted_0"""


@query("landuse_share", f"WITH {_OVERLAP} SELECT lsoa_code, {_LANDUSE_SQL} FROM o GROUP BY 1")
def _(t):
    return rounded(spatial.landuse_shares(_areas(t), _parcels(t), LANDUSE_TYPES))


_CLIP = """c AS (SELECT a.area_code AS lsoa_code, l.lit,
  CASE WHEN l.dx > 0 AND l.y1 BETWEEN a.y0 AND a.y0 + a.side THEN greatest(least(a.x0 + a.side, l.x1 + l.dx) - greatest(a.x0, l.x1), 0)
       WHEN l.dy > 0 AND l.x1 BETWEEN a.x0 AND a.x0 + a.side THEN greatest(least(a.y0 + a.side, l.y1 + l.dy) - greatest(a.y0, l.y1), 0) ELSE 0 END AS part
  FROM v_area a, v_lines l)"""
_LIT_SQL = "round(coalesce(sum(part) FILTER (lit = 'yes'), 0) / sum(part), 4) AS streetlit_percentage"


@query("streetlit_share", f"WITH {_CLIP} SELECT lsoa_code, {_LIT_SQL} FROM c WHERE part > 0 GROUP BY 1")
def _(t):
    return rounded(spatial.streetlit_share(_areas(t), _lines(t)))


MAP_SQL = f"""
WITH {_DIST}, {_OVERLAP}, {_CLIP},
m AS (SELECT lsoa_code, {_count_columns(C.AMENITY_GROUPS, 'amenity')}, {_NEAREST_SQL}, {_RATIO_SQL} FROM d GROUP BY 1),
u AS (SELECT lsoa_code, {_LANDUSE_SQL} FROM o GROUP BY 1),
s AS (SELECT lsoa_code, {_LIT_SQL} FROM c WHERE part > 0 GROUP BY 1)
SELECT * FROM m LEFT JOIN u USING (lsoa_code) LEFT JOIN s USING (lsoa_code)"""


def map_frame(t):
    return spatial.map_features(_areas(t), _points(t), _parcels(t), _lines(t), landuse_types=LANDUSE_TYPES)


@query("map_features", MAP_SQL)
def _(t):
    return rounded(map_frame(t))
