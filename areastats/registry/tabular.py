"""Queries on sales, crimes, claims, population, lookups, dates and runs."""

from pyspark.sql import functions as F

from areastats.constants import CLAIM_GROUPS, POPULATION_KEY, PRICE_COLUMNS, PROPERTY_TYPES
from areastats.functions import timewin
from areastats.functions.text import district_slug
from areastats.operators import claims, combine as comb, crime, geography as geo, population, prices, runs
from areastats.plans import features, states
from areastats.registry import spatial as maps
from areastats.registry.base import query, rounded
from areastats.sources import crime_feed, cube, inventory, month_table, readers, scratch, writers
from areastats.streaming import landing
from areastats.sources.schemas import PRICE_SCHEMA

SNAPSHOT = "1998-12-01"
MONTHS = 12
DISTRICT = "EUROPE"
STANDIN_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
STANDIN_OUTCOMES = ["A", "R"]
LISTS = {"categories": STANDIN_CATEGORIES, "outcomes": STANDIN_OUTCOMES}
BACKFILL = [f"{y}-{m:02d}-01" for y in (1997, 1998, 1999) for m in (1, 4, 7, 10)]

# ---------------------------------------------------------------- dates


@query("window_bounds", """
SELECT o_orderkey AS order_id, strftime(o_orderdate - INTERVAL 12 MONTH, '%Y-%m-%d') AS window_start,
       strftime(o_orderdate, '%Y-%m-%d') AS window_end
FROM orders""")
def _(t):
    bounds = timewin.window_bounds(F.col("o_orderdate"), MONTHS)
    return t.orders.select(F.col("o_orderkey").alias("order_id"), bounds.alias("b")).select(
        "order_id", F.col("b.start").cast("string").alias("window_start"), F.col("b.end").cast("string").alias("window_end")
    )


@query("months_in_window", """
SELECT strftime(o_orderdate - to_months(CAST(i AS INT)), '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS windows
FROM orders, range(0, 12) AS r(i) GROUP BY 1""")
def _(t):
    months = F.explode(timewin.months_in_window(F.col("o_orderdate"), MONTHS)).alias("month")
    return t.orders.select(months).groupBy("month").agg(F.count("*").alias("windows"))


@query("price_window", f"""
SELECT transaction_id, price, strftime(date_of_transfer, '%Y-%m-%d') AS sold_on FROM v_price
WHERE date_of_transfer BETWEEN DATE '{SNAPSHOT}' - INTERVAL {MONTHS} MONTH AND DATE '{SNAPSHOT}'""")
def _(t):
    kept = t.v_price.filter(timewin.in_window(F.col("date_of_transfer"), SNAPSHOT, MONTHS))
    return kept.select("transaction_id", "price", F.date_format("date_of_transfer", "yyyy-MM-dd").alias("sold_on"))


@query("years_in_window", """
WITH w AS (SELECT unnest(range(CAST(year(o_orderdate - INTERVAL 30 MONTH) AS BIGINT), CAST(year(o_orderdate) AS BIGINT) + 1)) AS y FROM orders)
SELECT CAST(y AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS windows FROM w GROUP BY 1""")
def _(t):
    years = F.explode(timewin.years_in_window(F.col("o_orderdate"), 30)).alias("year")
    return t.orders.select(years).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("windows"))


@query("missing_months", """
WITH req AS (SELECT strftime(d, '%Y-%m') AS month FROM range(DATE '1994-06-01', DATE '2002-07-01', INTERVAL 1 MONTH) AS r(d))
SELECT month FROM req
WHERE month BETWEEN (SELECT min(month) FROM v_crime) AND (SELECT max(month) FROM v_crime)
  AND month NOT IN (SELECT strftime(date_of_transfer, '%Y-%m') FROM v_price)""")
def _(t):
    stored = t.v_price.select(F.date_format("date_of_transfer", "yyyy-MM").alias("month"))
    start, end = timewin.as_date("1994-06-01"), timewin.as_date("2002-06-01")
    return runs.missing_months(start, end, t.v_crime.select("month"), stored)


@query("snapshot_dates", """
WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders)
SELECT strftime(d, '%Y-%m-%d') AS snapshot_date FROM (SELECT unnest(range(lo, hi, INTERVAL 3 MONTH)) AS d FROM b)""")
def _(t):
    ends = t.orders.agg(F.trunc(F.min("o_orderdate"), "MM").alias("lo"), F.trunc(F.max("o_orderdate"), "MM").alias("hi"))
    dates = F.explode(timewin.snapshot_dates(F.col("lo"), F.col("hi")))
    return ends.select(dates.alias("d")).select(F.col("d").cast("string").alias("snapshot_date"))


# ---------------------------------------------------------------- geography


@query("district_slug", """
SELECT c_custkey AS id, replace(trim(lower(replace(concat(' ', c_name, ', City of '), ' ', '_')), '_'), ',', '') AS slug FROM customer""")
def _(t):
    name = F.concat(F.lit(" "), F.col("c_name"), F.lit(", City of "))
    return t.customer.select(F.col("c_custkey").alias("id"), district_slug(name).alias("slug"))


@query("target_codes", f"SELECT lsoa_code_21 AS lsoa_code FROM v_geo WHERE lad_name = '{DISTRICT}'")
def _(t):
    return geo.target_codes(t.v_geo, DISTRICT)


@query("spine", f"SELECT DISTINCT lsoa_code_21 AS lsoa_code FROM v_geo WHERE lad_name = '{DISTRICT}'")
def _(t):
    return geo.area_spine(t.v_geo, DISTRICT)


@query("filter_areas", f"""
SELECT postcode, lsoa_code FROM v_postcode
WHERE lsoa_code IN (SELECT lsoa_code_21 FROM v_geo WHERE lad_name = '{DISTRICT}')""")
def _(t):
    return geo.filter_areas(t.v_postcode, "lsoa_code", DISTRICT, t.v_geo)


@query("recode_2011_2021", """
SELECT p.postcode, coalesce(m.lsoa_code_21, p.code) AS code
FROM (SELECT postcode, CASE WHEN postcode % 3 = 0 THEN 'OLD_SPLIT' WHEN postcode % 3 = 1 THEN concat('OLD_', lsoa_code) ELSE lsoa_code END AS code FROM v_postcode) p
LEFT JOIN (SELECT DISTINCT lsoa_code_11, lsoa_code_21 FROM v_geo) m ON p.code = m.lsoa_code_11""")
def _(t):
    third = F.col("postcode") % 3
    code = F.when(third == 0, "OLD_SPLIT").when(third == 1, F.concat(F.lit("OLD_"), "lsoa_code")).otherwise(F.col("lsoa_code"))
    return geo.recode_2011_2021(t.v_postcode.select("postcode", code.alias("code")), "code", t.v_geo)


@query("names_to_codes", """
SELECT u.month, u.condition_group, u.value, g.lsoa_code_21 AS lsoa_code
FROM (SELECT month, condition_group, value, CASE WHEN value % 10 = 0 THEN 'Total' ELSE lsoa_name END AS lsoa_name FROM v_uc) u
LEFT JOIN (SELECT DISTINCT lsoa_name_21, lsoa_code_21 FROM v_geo) g ON u.lsoa_name = g.lsoa_name_21""")
def _(t):
    name = F.when(F.col("value") % 10 == 0, "Total").otherwise(F.col("lsoa_name"))
    return geo.names_to_codes(t.v_uc.withColumn("lsoa_name", name), "lsoa_name", t.v_geo)


@query("postcode_to_area", """
SELECT s.transaction_id, s.price, p.lsoa_code
FROM (SELECT transaction_id, price, CASE WHEN transaction_id % 10 = 0 THEN NULL ELSE postcode END AS postcode FROM v_price) s
LEFT JOIN v_postcode p ON s.postcode = p.postcode""")
def _(t):
    some = F.when(F.col("transaction_id") % 10 != 0, F.col("postcode")).alias("postcode")
    return geo.postcode_to_area(t.v_price.select("transaction_id", "price", some), "postcode", t.v_postcode)


@query("postcode_lookup", f"""
SELECT p.postcode, p.lsoa_code, concat('M_', p.lsoa_code) AS msoa_code
FROM v_postcode p JOIN v_geo g ON p.lsoa_code = g.lsoa_code_21 WHERE g.lad_name = '{DISTRICT}'""")
def _(t):
    raw = t.v_postcode.join(t.v_geo, F.col("lsoa_code") == F.col("lsoa_code_21")).select(
        F.col("lad_name").alias("ladnm"),
        F.col("postcode").alias("pcds"),
        F.col("lsoa_code").alias("lsoa21cd"),
        F.concat(F.lit("M_"), "lsoa_code").alias("msoa21cd"),
    )
    return geo.build_postcode_lookup(raw, [DISTRICT])


@query("code_change_lookup", f"""
SELECT concat('D_', lad_name) AS local_authority_code, lsoa_code_21, lsoa_name_21, lsoa_code_11, concat('Old ', lsoa_name_21) AS lsoa_name_11
FROM v_geo WHERE lad_name = '{DISTRICT}'""")
def _(t):
    raw = t.v_geo.select(
        F.concat(F.lit("D_"), "lad_name").alias("LAD22CD"), F.col("lad_name").alias("LAD22NM"),
        F.col("lsoa_code_21").alias("LSOA21CD"), F.col("lsoa_name_21").alias("LSOA21NM"),
        F.col("lsoa_code_11").alias("LSOA11CD"), F.concat(F.lit("Old "), "lsoa_name_21").alias("LSOA11NM"),
    )
    return geo.build_code_change_lookup(raw, DISTRICT)


@query("geography_lookup", """
SELECT CAST(id AS STRING) AS geo_point, concat('shape ', CAST(id AS STRING)) AS geo_shape, amenity AS lsoa_code, x AS easting, y AS northing,
       x + 1 AS longitude, y + 1 AS latitude, amenity AS local_authority_code
FROM v_points""")
def _(t):
    raw = t.v_points.select(
        F.col("id").cast("string").alias("Geo Point"), F.concat(F.lit("shape "), "id").alias("Geo Shape"),
        F.col("amenity").alias("LSOA Code"), F.col("x").alias("Easting"), F.col("y").alias("Northing"),
        (F.col("x") + 1).alias("Longitude"), (F.col("y") + 1).alias("Latitude"), F.col("amenity").alias("Local Authority Code"),
    )
    return geo.build_geography_lookup(raw)


@query("connectivity", """
SELECT g.lad_name AS district, c.LSOA21CD AS lsoa_code, CAST(c.stops AS BIGINT) AS stops, c.score_pence
FROM v_connectivity c JOIN (SELECT DISTINCT lad_name, lsoa_code_21 FROM v_geo) g ON c.LSOA21CD = g.lsoa_code_21""")
def _(t):
    return features.connectivity_plan(t.v_connectivity, t.v_geo)


# ---------------------------------------------------------------- sources


@query("price_scan", """
SELECT CAST(transaction_id AS STRING) AS transaction_id, price, strftime(date_of_transfer, '%Y-%m-%d') AS sold_on,
       CAST(postcode AS STRING) AS postcode, property_type, old_new, duration, 'A' AS record_status
FROM v_price""")
def _(t):
    given = t.v_price
    text = {c: F.col(c).cast("string") for c in given.columns}
    text["date_of_transfer"] = F.date_format("date_of_transfer", "yyyy-MM-dd HH:mm")
    text["record_status"] = F.lit("A")
    line = F.to_csv(F.struct(*[text.get(c, F.lit("")).alias(c) for c in PRICE_COLUMNS]))
    parsed = F.from_csv(line, PRICE_SCHEMA, {"timestampNTZFormat": "yyyy-MM-dd HH:mm"})
    return given.select(parsed.alias("s")).select("s.*").select(
        "transaction_id", "price", F.date_format("date_of_transfer", "yyyy-MM-dd").alias("sold_on"),
        "postcode", "property_type", "old_new", "duration", "record_status",
    )


@query("crime_scan", """
SELECT lsoa_code, month, category, CAST(count(*) AS BIGINT) AS crimes FROM v_crime
WHERE month BETWEEN '1998-01' AND '1998-12' GROUP BY 1, 2, 3""")
def _(t):
    kept = t.v_crime.filter(timewin.month_in_window(F.col("month"), SNAPSHOT, MONTHS))
    return kept.groupBy("lsoa_code", "month", "category").agg(F.count("*").alias("crimes"))


@query("uc_flatten", """
SELECT lsoa_name, concat('m_', month) AS month, CAST(value AS DOUBLE) AS value, condition_group FROM v_uc""")
def _(t):
    return _cubes(t, F.concat(F.lit("M "), "month"))


def _cubes(t, label):
    """One response per area and group; months of one area bound the size of a response."""
    cell = F.when(F.col("value") % 2 == 0, F.to_json(F.array("value"))).otherwise(F.col("value").cast("string"))
    per_area = t.v_uc.groupBy("condition_group", "lsoa_name").agg(
        F.array_sort(F.collect_list(F.struct("month", cell.alias("cell"), label.alias("label")))).alias("m")
    )
    labels = F.array_join(F.transform("m", lambda s: F.concat(F.lit('"'), s["label"], F.lit('"'))), ",")
    cells = F.array_join(F.transform("m", lambda s: s["cell"]), ",")
    payload = F.concat(
        F.lit('{"fields":[{"label":"National - Regional - LA - OAs","items":[{"labels":["'), F.col("lsoa_name"),
        F.lit('"]}]},{"label":"Month","items":[{"labels":['), labels,
        F.lit(']}]}],"cubes":{"c":{"values":[['), cells, F.lit("]]}}}"),
    )
    return cube.flatten_cubes(per_area.withColumn("payload", payload), F.col("payload"))


@query("crime_labels", """
SELECT id, CASE kind WHEN 'Drugs' THEN 'drugs' WHEN 'Violence and sexual offences' THEN 'violent-crime' ELSE kind END AS kind
FROM (SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'Drugs' WHEN 'SMALL' THEN 'Violence and sexual offences' WHEN 'LARGE' THEN NULL ELSE p_type END AS kind FROM part)""")
def _(t):
    kind = F.when(F.col("p_type") == "PROMO", "Drugs").when(F.col("p_type") == "SMALL", "Violence and sexual offences")
    kind = kind.when(F.col("p_type") != "LARGE", F.col("p_type"))
    return crime_feed.label_crimes(t.part.select(F.col("p_partkey").alias("id"), kind.alias("kind")), "kind")


_BULK_SQL = """
WITH street AS (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS crime_id,
    strftime(l_shipdate, '%Y-%m') AS month, CASE WHEN s_nationkey % 6 = 0 THEN concat('OLD_', n_name) WHEN s_nationkey IN (23, 24) THEN 'OLD_SPLIT' ELSE n_name END AS code,
    CASE p_type WHEN 'PROMO' THEN 'Drugs' ELSE p_type END AS kind
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
outcomes AS (SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS crime_id, strftime(l_shipdate, '%Y-%m') AS month,
    unnest(CASE l_returnflag WHEN 'N' THEN ['Local resolution'] WHEN 'A' THEN ['Under investigation', 'Local resolution'] ELSE [] END) AS outcome FROM lineitem),
recoded AS (SELECT s.crime_id, s.month, s.kind, coalesce(m.lsoa_code_21, s.code) AS code
  FROM street s LEFT JOIN (SELECT DISTINCT lsoa_code_11, lsoa_code_21 FROM v_geo) m ON s.code = m.lsoa_code_11 WHERE s.crime_id IS NOT NULL)
SELECT r.month, g.lad_name AS district, r.code AS lsoa_code, CASE r.kind WHEN 'Drugs' THEN 'drugs' ELSE r.kind END AS category,
       o.outcome AS outcome_status, CAST(count(*) AS BIGINT) AS crimes
FROM recoded r JOIN (SELECT DISTINCT lad_name, lsoa_code_21 FROM v_geo) g ON r.code = g.lsoa_code_21
LEFT JOIN outcomes o ON r.crime_id = o.crime_id AND r.month = o.month GROUP BY ALL"""


def _bulk(t):
    crime_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    nation = F.col("s_nationkey")
    code = F.when(nation % 6 == 0, F.concat(F.lit("OLD_"), "n_name")).when(nation.isin(23, 24), "OLD_SPLIT").otherwise(F.col("n_name"))
    kind = F.when(F.col("p_type") == "PROMO", "Drugs").otherwise(F.col("p_type"))
    street = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.when(F.col("l_linenumber") != 3, crime_id).alias("Crime ID"), month,
            code.alias("LSOA code"), kind.alias("Crime type"),
        )
    )
    events = (
        F.when(F.col("l_returnflag") == "N", F.array(F.lit("Local resolution")))
        .when(F.col("l_returnflag") == "A", F.array(F.lit("Under investigation"), F.lit("Local resolution")))
    )
    outcomes = t.lineitem.select(crime_id.alias("Crime ID"), month, F.explode(events).alias("Outcome type"))
    return crime_feed.merge_bulk_crime(street, outcomes, t.v_geo, geo.districts_areas(t.v_geo))


@query("crime_bulk", _BULK_SQL)
def _(t):
    return _bulk(t).groupBy("month", "district", "lsoa_code", "category", "outcome_status").agg(F.count("*").alias("crimes"))


_BULK_LISTS = {"categories": ["drugs", "LARGE", "SMALL"], "outcomes": ["Local resolution", "Under investigation"]}


def _weighed(column, labels):
    return f"CAST(coalesce(sum(crimes) FILTER ({column} IN ('" + "', '".join(labels) + "')), 0) AS BIGINT)"


@query("crime_chain", f"""
WITH bulk AS ({_BULK_SQL})
SELECT district, lsoa_code, {", ".join(f'{_weighed(c, [x])} AS "{x}"' for c, k in (("category", "categories"), ("outcome_status", "outcomes")) for x in _BULK_LISTS[k])},
  {_weighed("category", _BULK_LISTS["categories"])} AS total_crimes,
  round({_weighed("outcome_status", _BULK_LISTS["outcomes"])} / nullif({_weighed("category", _BULK_LISTS["categories"])}, 0), 4) AS resolution_rate
FROM bulk WHERE month BETWEEN '1998-01' AND '1998-12' GROUP BY 1, 2""")
def _(t):
    """Bulk files to features in one chain."""
    return rounded(features.crime_plan(_bulk(t), t.v_geo, [SNAPSHOT], MONTHS, **_BULK_LISTS).drop("snapshot_date"))


@query("crime_normalise", """
SELECT lsoa_code, month, category, outcome_status, CAST(count(*) AS BIGINT) AS crimes FROM v_crime GROUP BY 1, 2, 3, 4""")
def _(t):
    parent = F.when(F.col("outcome_status").isNotNull(), F.struct(F.col("outcome_status").alias("category")))
    body = F.to_json(F.struct("category", parent.alias("outcome_status")), {"ignoreNullFields": "false"})
    parsed = crime_feed.normalise_api_crimes(t.v_crime.withColumn("body", body), F.col("body"))
    return parsed.groupBy(*parsed.columns).agg(F.count("*").alias("crimes"))


@query("file_inventory", """
SELECT 'sales' AS source, 'orders.parquet' AS file_name, true AS has_size, CAST(count(*) AS BIGINT) AS n_rows FROM orders
UNION ALL SELECT 'crime', 'lineitem.parquet', true, CAST(count(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'map', 'events.parquet', true, CAST(count(*) AS BIGINT) FROM events""")
def _(t):
    found = inventory.file_inventory(t.orders, "sales")
    found = found.unionByName(inventory.file_inventory(t.lineitem, "crime"))
    found = found.unionByName(inventory.file_inventory(t.events, "map"))
    return found.select("source", "file_name", (F.col("file_size_mb") > 0).alias("has_size"), "n_rows")


# ---------------------------------------------------------------- prices

_SALES = """sales AS (SELECT g.lad_name AS district, p.lsoa_code, s.transaction_id, s.price, s.date_of_transfer, s.property_type, s.old_new, s.duration
  FROM v_price s JOIN v_postcode p ON s.postcode = p.postcode JOIN (SELECT DISTINCT lad_name, lsoa_code_21 FROM v_geo) g ON p.lsoa_code = g.lsoa_code_21)"""

_NEAREST = "list_sort(list(price))[CAST(floor((count(price) - 1) * {q}::DOUBLE + 0.5) AS INT) + 1]"

PRICE_SQL = {
    "lsoa_mean_price": "round(avg(price), 4)",
    "lsoa_median_price": "round(median(price), 4)",
    "lsoa_stdev_price": "round(stddev_samp(price), 4)",
    "lsoa_max_price": "max(price)",
    "lsoa_min_price": "min(price)",
    "lsoa_range_price": "max(price) - min(price)",
    "lsoa_price_inequality": f"round(CASE WHEN {_NEAREST.format(q=0.1)} > 0 THEN {_NEAREST.format(q=0.9)} / {_NEAREST.format(q=0.1)} END, 4)",
    **{f"{c}_mean_price": f"round(coalesce(avg(price) FILTER (property_type = '{c}'), 0), 4)" for c in PROPERTY_TYPES},
    "total_transactions": "CAST(count(*) AS BIGINT)",
    **{f"{c}_count_transactions": f"CAST(count(*) FILTER (property_type = '{c}') AS BIGINT)" for c in PROPERTY_TYPES},
    "new_build_proportion": "round(count(*) FILTER (old_new = 'Y') / count(*), 4)",
    "freehold_proportion": "round(count(*) FILTER (duration = 'F') / count(*), 4)",
    **{f"{n}_proportion": f"round(count(*) FILTER (property_type = '{c}') / count(*), 4)" for c, n in PROPERTY_TYPES.items()},
    "new_build_price_premium": "round(CASE WHEN count(*) FILTER (old_new = 'Y') > 0 THEN coalesce(avg(price) FILTER (old_new = 'Y') / avg(price) FILTER (old_new = 'N'), 0) END, 4)",
}


def _price_sql(names, keys="lsoa_code", source="sales", having=""):
    cols = ", ".join(f'{PRICE_SQL[n]} AS "{n}"' for n in names)
    return f"WITH {_SALES} SELECT {keys}, {cols} FROM {source} GROUP BY {keys} {having}"


def _sales(t):
    return features.sales_with_area(t.v_price, t.v_postcode, t.v_geo)


_SINGLE = {
    "price_mean": (prices.mean_price, ["lsoa_mean_price"]),
    "price_median": (prices.median_price, ["lsoa_median_price"]),
    "price_stdev": (prices.stdev_price, ["lsoa_stdev_price"]),
    "price_max": (prices.max_price, ["lsoa_max_price"]),
    "price_min": (prices.min_price, ["lsoa_min_price"]),
    "price_range": (prices.range_price, ["lsoa_range_price"]),
    "price_inequality": (prices.price_inequality, ["lsoa_price_inequality"]),
    "price_by_type": (prices.mean_price_by_type, [f"{c}_mean_price" for c in PROPERTY_TYPES]),
    "transactions": (prices.transactions, ["total_transactions"]),
    "transactions_by_type": (prices.transactions_by_type, [f"{c}_count_transactions" for c in PROPERTY_TYPES]),
    "new_build_share": (prices.new_build_share, ["new_build_proportion"]),
    "freehold_share": (prices.freehold_share, ["freehold_proportion"]),
    "type_share": (prices.type_share, [f"{n}_proportion" for n in PROPERTY_TYPES.values()]),
}
for _name, (_fn, _cols) in _SINGLE.items():
    query(_name, _price_sql(_cols))(lambda t, fn=_fn: rounded(fn(_sales(t))))

query(
    "new_build_premium",
    _price_sql(["new_build_price_premium"], having="HAVING count(*) FILTER (old_new = 'Y') > 0"),
)(lambda t: rounded(prices.new_build_premium(_sales(t))))

_WINDOW = f"date_of_transfer BETWEEN DATE '{SNAPSHOT}' - INTERVAL {MONTHS} MONTH AND DATE '{SNAPSHOT}'"


@query("price_features", _price_sql(PRICE_SQL, "district, lsoa_code", f"(SELECT * FROM sales WHERE {_WINDOW})"))
def _(t):
    plan = features.price_plan(t.v_price, t.v_postcode, t.v_geo, [SNAPSHOT], MONTHS)
    return rounded(plan.drop("snapshot_date"))


@query("price_features_district", _price_sql(
    PRICE_SQL, "lsoa_code", f"(SELECT * FROM sales WHERE {_WINDOW} AND district = '{DISTRICT}')"))
def _(t):
    plan = features.price_plan(t.v_price, t.v_postcode, t.v_geo, [SNAPSHOT], MONTHS, [DISTRICT])
    return rounded(plan.drop("snapshot_date", "district"))


# ---------------------------------------------------------------- crime


def _count_sql(column, labels):
    return ", ".join(f"CAST(count(*) FILTER ({column} = '{x}') AS BIGINT) AS \"{x}\"" for x in labels)


_CATEGORY_SQL = _count_sql("category", STANDIN_CATEGORIES)
_OUTCOME_SQL = _count_sql("outcome_status", STANDIN_OUTCOMES)
_LISTED = "count(*) FILTER (category IN ('" + "', '".join(STANDIN_CATEGORIES) + "'))"
_CRIME_STATS_SQL = f"""{_CATEGORY_SQL}, {_OUTCOME_SQL}, CAST({_LISTED} AS BIGINT) AS total_crimes,
  round(count(*) FILTER (outcome_status IN ('A', 'R')) / nullif({_LISTED}, 0), 4) AS resolution_rate"""


@query("crime_by_category", f"SELECT lsoa_code, {_CATEGORY_SQL} FROM v_crime GROUP BY 1")
def _(t):
    return crime.crime_by_category(t.v_crime, categories=STANDIN_CATEGORIES)


@query("crime_by_outcome", f"SELECT lsoa_code, {_OUTCOME_SQL} FROM v_crime GROUP BY 1")
def _(t):
    return crime.crime_by_outcome(t.v_crime, outcomes=STANDIN_OUTCOMES)


_AREA = "(SELECT DISTINCT lad_name AS district, lsoa_code_21 AS lsoa_code FROM v_geo)"


@query("crime_features", f"""
SELECT district, lsoa_code, {_CRIME_STATS_SQL} FROM v_crime JOIN {_AREA} USING (lsoa_code)
WHERE month BETWEEN '1998-01' AND '1998-12' GROUP BY 1, 2""")
def _(t):
    return rounded(features.crime_plan(t.v_crime, t.v_geo, [SNAPSHOT], MONTHS, **LISTS).drop("snapshot_date"))


@query("all_districts", f"SELECT district, lsoa_code, {_CRIME_STATS_SQL} FROM v_crime JOIN {_AREA} USING (lsoa_code) GROUP BY 1, 2")
def _(t):
    rows = geo.attach_district(t.v_crime, "lsoa_code", geo.districts_areas(t.v_geo))
    return rounded(crime.crime_features(rows, features.AREA_KEYS, **LISTS))


# ---------------------------------------------------------------- claims and population

_TOTALS_SQL = "CAST(coalesce(sum(value), 0) AS BIGINT) AS total_claims, " + ", ".join(
    f"CAST(coalesce(sum(value) FILTER (condition_group = '{g}'), 0) AS BIGINT) AS total_{s}_claims" for s, g in CLAIM_GROUPS.items()
)
_SHARES_SQL = ", ".join(
    f"round(coalesce(sum(value) FILTER (condition_group = '{g}'), 0) / nullif(sum(value), 0), 4) AS \"%_claims_{s}\"" for s, g in CLAIM_GROUPS.items()
)
_MEANS_SQL = "round(avg(m_all), 4) AS mean_monthly_claims, " + ", ".join(f"round(avg(m_{s}), 4) AS mean_monthly_{s}_claims" for s in CLAIM_GROUPS)
_CLAIMS_SQL = f"""claims AS (SELECT a.district, a.lsoa_code, u.month, u.condition_group, u.value FROM v_uc u
  JOIN (SELECT DISTINCT lsoa_name_21, lsoa_code_21 FROM v_geo) g ON u.lsoa_name = g.lsoa_name_21 JOIN {_AREA} a ON a.lsoa_code = g.lsoa_code_21)"""


def _monthly_sql(source):
    sums = ", ".join(
        f"coalesce(sum(value) FILTER (condition_group = '{g}') OVER w, 0) AS m_{s}" for s, g in CLAIM_GROUPS.items()
    )
    return f"monthly AS (SELECT *, sum(value) OVER w AS m_all, {sums} FROM {source} WINDOW w AS (PARTITION BY lsoa_code, month))"


def _claims(t):
    return geo.names_to_codes(t.v_uc, "lsoa_name", t.v_geo)


@query("uc_totals", f"WITH {_CLAIMS_SQL} SELECT lsoa_code, {_TOTALS_SQL} FROM claims GROUP BY 1")
def _(t):
    return claims.claim_totals(_claims(t))


@query("uc_monthly", f"WITH {_CLAIMS_SQL}, {_monthly_sql('claims')} SELECT lsoa_code, {_MEANS_SQL} FROM monthly GROUP BY 1")
def _(t):
    return rounded(claims.claim_monthly_means(_claims(t)))


@query("uc_shares", f"WITH {_CLAIMS_SQL} SELECT lsoa_code, {_TOTALS_SQL}, {_SHARES_SQL} FROM claims GROUP BY 1")
def _(t):
    return rounded(claims.claim_shares(claims.claim_totals(_claims(t))))


_UC_WINDOW = "(SELECT * FROM claims WHERE month BETWEEN '1998-01' AND '1998-12')"


@query("uc_features", f"""
WITH {_CLAIMS_SQL}, {_monthly_sql(_UC_WINDOW)}
SELECT district, lsoa_code, {_TOTALS_SQL}, {_MEANS_SQL}, {_SHARES_SQL} FROM monthly GROUP BY 1, 2""")
def _(t):
    return rounded(features.claim_plan(t.v_uc, t.v_geo, [SNAPSHOT], MONTHS).drop("snapshot_date"))


@query("claims_chain", f"""
WITH {_CLAIMS_SQL}, {_monthly_sql(_UC_WINDOW)}
SELECT district, lsoa_code, {_TOTALS_SQL}, {_MEANS_SQL}, {_SHARES_SQL} FROM monthly GROUP BY 1, 2""")
def _(t):
    """Cubes with month names to features in one chain."""
    month = F.date_format(F.to_date(F.concat("month", F.lit("-01"))), "MMMM yyyy")
    rows = _cubes(t, month).withColumn("value", F.col("value").cast("long"))
    return rounded(features.claim_plan(rows, t.v_geo, [SNAPSHOT], MONTHS).drop("snapshot_date"))


_BANDS = ["F0 to 15", "M16 to 29", "F30 to 44", "M45 to 64", "F65 and over"]


def _people(t, key=POPULATION_KEY, names=None):
    wide = t.v_pop_long.groupBy("area_code").pivot("band", _BANDS).agg(F.sum("people"))
    return wide.withColumnsRenamed({"area_code": key, **(names or {})})


_POPULATION_SQL = f"""SELECT a.district, p.area_code AS lsoa_code, CAST(sum(people) AS BIGINT) AS lsoa_population,
  CAST(coalesce(sum(people) FILTER (band = 'F0 to 15'), 0) AS BIGINT) AS aged_under_15,
  CAST(coalesce(sum(people) FILTER (band IN ('M16 to 29', 'F30 to 44', 'M45 to 64')), 0) AS BIGINT) AS working_age_population,
  CAST(coalesce(sum(people) FILTER (band = 'F65 and over'), 0) AS BIGINT) AS pension_age_population
FROM v_pop_long p JOIN {_AREA} a ON p.area_code = a.lsoa_code GROUP BY 1, 2"""


@query("population", _POPULATION_SQL)
def _(t):
    return features.population_plan(_people(t), t.v_geo)


@query("population_headers", """
SELECT area_code AS lsoa_code, CAST(coalesce(sum(people) FILTER (band = 'F0 to 15'), 0) AS BIGINT) AS aged_0_to_15,
  CAST(coalesce(sum(people) FILTER (band = 'M16 to 29'), 0) AS BIGINT) AS aged_16_to_29,
  CAST(coalesce(sum(people) FILTER (band = 'F30 to 44'), 0) AS BIGINT) AS aged_30_to_44,
  CAST(coalesce(sum(people) FILTER (band = 'M45 to 64'), 0) AS BIGINT) AS aged_45_to_64,
  CAST(coalesce(sum(people) FILTER (band = 'F65 and over'), 0) AS BIGINT) AS aged_65_and_over FROM v_pop_long GROUP BY 1""")
def _(t):
    headers = {
        "F0 to 15": "0 - 15 years old population", "M16 to 29": "16 - 29 years old population",
        "F30 to 44": "30 - 44 years old population", "M45 to 64": "45 - 64 years old population",
        "F65 and over": "65 years old and over population",
    }
    return population.snake_headers(_people(t, "lsoa_code", headers), keep=["lsoa_code"]).fillna(0)


# ---------------------------------------------------------------- combine, reports, runs


def _frames(t):
    people, scores = features.population_plan(_people(t), t.v_geo), features.connectivity_plan(t.v_connectivity, t.v_geo)
    return [
        features.price_plan(t.v_price, t.v_postcode, t.v_geo, [SNAPSHOT], MONTHS),
        features.crime_plan(t.v_crime, t.v_geo, [SNAPSHOT], MONTHS, **LISTS),
        features.claim_plan(t.v_uc, t.v_geo, [SNAPSHOT], MONTHS),
        people,
        scores,
    ]


def _spine(t):
    return features.spine_plan(t.v_geo, [SNAPSHOT])


_COMBINE_SQL = f"""WITH {_SALES}, {_CLAIMS_SQL}, {_monthly_sql(_UC_WINDOW)},
p AS (SELECT lsoa_code, {", ".join(f'{sql} AS "{name}"' for name, sql in PRICE_SQL.items())} FROM sales WHERE {_WINDOW} GROUP BY 1),
c AS (SELECT lsoa_code, {_CRIME_STATS_SQL} FROM v_crime WHERE month BETWEEN '1998-01' AND '1998-12' GROUP BY 1),
u AS (SELECT lsoa_code, {_TOTALS_SQL}, {_MEANS_SQL}, {_SHARES_SQL} FROM monthly GROUP BY 1),
pop AS ({_POPULATION_SQL})
SELECT a.district, a.lsoa_code, p.* EXCLUDE (lsoa_code), c.* EXCLUDE (lsoa_code), u.* EXCLUDE (lsoa_code),
  pop.lsoa_population, pop.aged_under_15, pop.working_age_population, pop.pension_age_population, CAST(s.stops AS BIGINT) AS stops, s.score_pence
FROM {_AREA} a LEFT JOIN p USING (lsoa_code) LEFT JOIN c USING (lsoa_code) LEFT JOIN u USING (lsoa_code) LEFT JOIN pop USING (lsoa_code)
LEFT JOIN v_connectivity s ON s.LSOA21CD = a.lsoa_code"""


@query("combine", _COMBINE_SQL)
def _(t):
    return rounded(comb.combine(_spine(t), *_frames(t), keys=features.RUN_KEYS).drop("snapshot_date"))


_COMBINE_ALL_SQL = f"""WITH b AS ({_COMBINE_SQL}), maps AS ({maps.MAP_SQL}) SELECT b.*, maps.* EXCLUDE (lsoa_code) FROM b LEFT JOIN maps USING (lsoa_code)"""


def _all_frames(t):
    return [*_frames(t), geo.attach_district(maps.map_frame(t), "lsoa_code", geo.districts_areas(t.v_geo))]


@query("combine_all", _COMBINE_ALL_SQL)
def _(t):
    """Every source, the map features too."""
    return rounded(comb.combine(_spine(t), *_all_frames(t), keys=features.RUN_KEYS).drop("snapshot_date"))


@query("combine_checks", f"""
SELECT CAST(count(*) AS BIGINT) AS expected_rows, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS null_keys
FROM {_AREA}""")
def _(t):
    combined = comb.combine(_spine(t), *_all_frames(t), keys=features.RUN_KEYS)
    return comb.structure_report(combined, _spine(t), features.RUN_KEYS)


_DIRTY_SQL = """(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN CAST('-Infinity' AS DOUBLE)
  WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS amount,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS buyer, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders)"""


def _dirty(t):
    k = F.col("o_orderkey")
    inf, nan = float("inf"), float("nan")
    amount = F.when(k % 7 == 0, inf).when(k % 11 == 0, -inf).when(k % 5 == 0, nan).when(k % 3 != 0, F.col("o_totalprice"))
    return t.orders.select(
        k.alias("id"), amount.alias("amount"),
        F.when(k % 4 != 0, F.col("o_custkey")).alias("buyer"), F.when(k % 6 != 0, F.col("o_orderstatus")).alias("status"),
    )


@query("quality_report", f"""
WITH d AS (SELECT * FROM {_DIRTY_SQL})
SELECT 'amount' AS "column", CAST(count(*) FILTER (isinf(amount)) AS BIGINT) AS inf_count, CAST(count(*) FILTER (isnan(amount)) AS BIGINT) AS nan_count, CAST(count(*) FILTER (amount IS NULL) AS BIGINT) AS null_count FROM d
UNION ALL SELECT 'buyer', 0, 0, CAST(count(*) FILTER (buyer IS NULL) AS BIGINT) FROM d
UNION ALL SELECT 'status', 0, 0, CAST(count(*) FILTER (status IS NULL) AS BIGINT) FROM d""")
def _(t):
    return comb.quality_report(_dirty(t), keys=["id"])


@query("combine_fill", f"""
SELECT id, CASE WHEN amount IS NULL OR isnan(amount) OR isinf(amount) THEN 0 ELSE amount END AS amount, coalesce(buyer, 0) AS buyer, status FROM {_DIRTY_SQL}""")
def _(t):
    return comb.fill(_dirty(t), keys=["id"])


@query("stitch", f"""
WITH {_SALES},
a AS (SELECT lsoa_code, CAST(count(*) AS DOUBLE) AS volume, CAST(max(price) AS BIGINT) AS top FROM sales GROUP BY 1),
b AS (SELECT lsoa_code, round(avg(price) / 3, 4) AS volume, CAST(min(price) AS BIGINT) AS bottom FROM sales GROUP BY 1)
SELECT lsoa_code, volume, top, CAST(0 AS BIGINT) AS bottom FROM a UNION ALL SELECT lsoa_code, volume, 0, bottom FROM b""")
def _(t):
    sales = _sales(t)
    a = sales.groupBy("lsoa_code").agg(F.count("*").alias("volume"), F.max("price").alias("top"))
    b = sales.groupBy("lsoa_code").agg((F.avg("price") / 3).alias("volume"), F.min("price").alias("bottom"))
    return rounded(comb.stitch([a, b]))


_DESCRIBED = {
    "price": "price", "n_terraced": "CASE WHEN property_type = 'T' THEN 1 ELSE 0 END", "half": "CASE WHEN old_new = 'Y' THEN NULL ELSE price / 2 END",
    "crowded": "CASE WHEN duration = 'L' THEN 1 + CAST(price AS DOUBLE) / 1e9 ELSE CAST('NaN' AS DOUBLE) END", "share": "CAST(price AS DOUBLE) / 1e9",
}


def _describe_sql(name, expr):
    def q(v):
        return f"list_sort(list(v))[CAST(floor((count(v) - 1) * {v}::DOUBLE + 0.5) AS INT) + 1]"

    return f"""SELECT '{name}' AS "column", CAST(count(v) AS BIGINT) AS "count", CAST(count(*) FILTER (x IS NULL) AS BIGINT) AS null_count, CAST(count(*) FILTER (isnan(x)) AS BIGINT) AS nan_count, round(avg(v), 4) AS mean,
round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min, round({q(0.25)}, 4) AS "25%", round({q(0.5)}, 4) AS "50%", round({q(0.75)}, 4) AS "75%", round(max(v), 4) AS max
FROM (SELECT x, CASE WHEN NOT isnan(x) THEN x END AS v FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM v_price))"""


@query("describe", " UNION ALL ".join(_describe_sql(n, e) for n, e in _DESCRIBED.items()))
def _(t):
    wide = t.v_price.select("transaction_id", *[F.expr(e).alias(n) for n, e in _DESCRIBED.items()])
    return rounded(comb.describe(wide, keys=["transaction_id"]))


@query("describe_text", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", CAST(count(*) - count({c}) AS BIGINT) AS null_count, min({c}) AS min, max({c}) AS max FROM v_crime"""
for c in ("category", "lsoa_code", "month", "outcome_status")))
def _(t):
    return comb.describe_text(t.v_crime, keys=[])


_BACKFILL_SQL = "(SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in BACKFILL) + "]) AS snap)"


@query("backfill", f"""
WITH {_SALES},
pending AS (SELECT s.snap, d.district FROM {_BACKFILL_SQL} s, (SELECT DISTINCT district FROM {_AREA}) d
  WHERE NOT (s.snap = DATE '{BACKFILL[0]}' AND d.district = '{DISTRICT}'))
SELECT strftime(p.snap, '%Y-%m-%d') AS snapshot_date, p.district, s.lsoa_code, CAST(count(*) AS BIGINT) AS total_transactions,
  {PRICE_SQL['lsoa_mean_price']} AS lsoa_mean_price, {PRICE_SQL['lsoa_median_price']} AS lsoa_median_price, {PRICE_SQL['lsoa_price_inequality']} AS lsoa_price_inequality
FROM pending p JOIN sales s ON s.district = p.district AND s.date_of_transfer BETWEEN p.snap - INTERVAL {MONTHS} MONTH AND p.snap
GROUP BY 1, 2, 3""")
def _(t):
    """The first snapshot of one district is stored; what is pending follows from that table."""
    plan = lambda snapshots, districts=None: features.price_plan(t.v_price, t.v_postcode, t.v_geo, snapshots, MONTHS, districts)
    wanted = ["total_transactions", "lsoa_mean_price", "lsoa_median_price", "lsoa_price_inequality"]
    return _pending(t, plan).select(F.col("snapshot_date").cast("string"), "district", "lsoa_code", *wanted)


def _pending(t, plan):
    """Features of all snapshots and districts that a table, which holds one of each, does not."""
    folder = scratch.shared_folder(t.spark)
    writers.write_features(plan([BACKFILL[0]], [DISTRICT]), folder, "features")
    due = runs.pending_runs(
        runs.plan_runs(BACKFILL, geo.districts_areas(t.v_geo)), readers.read_features(t.spark, folder, "features")
    )
    return rounded(plan(BACKFILL).join(due, ["snapshot_date", "district"], "left_semi"))


_PENDING_SQL = f"""pending AS (SELECT s.snap, d.district FROM {_BACKFILL_SQL} s, (SELECT DISTINCT district FROM {_AREA}) d
  WHERE NOT (s.snap = DATE '{BACKFILL[0]}' AND d.district = '{DISTRICT}'))"""
_PENDING_MONTHS = f"month BETWEEN strftime(snap - INTERVAL {MONTHS - 1} MONTH, '%Y-%m') AND strftime(snap, '%Y-%m')"


@query("backfill_crimes", f"""
WITH {_PENDING_SQL}
SELECT strftime(snap, '%Y-%m-%d') AS snapshot_date, district, lsoa_code, {_CRIME_STATS_SQL}
FROM v_crime JOIN {_AREA} USING (lsoa_code) JOIN pending USING (district) WHERE {_PENDING_MONTHS} GROUP BY 1, 2, 3""")
def _(t):
    due = _pending(t, lambda snapshots, districts=None: features.crime_plan(t.v_crime, t.v_geo, snapshots, MONTHS, districts, **LISTS))
    return due.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


_PENDING_CLAIMS = f"(SELECT strftime(snap, '%Y-%m-%d') AS snapshot_date, claims.* FROM claims JOIN pending USING (district) WHERE {_PENDING_MONTHS})"
_PENDING_MONTHLY = _monthly_sql(_PENDING_CLAIMS).replace("PARTITION BY", "PARTITION BY snapshot_date, district,")


@query("backfill_claims", f"""
WITH {_CLAIMS_SQL}, {_PENDING_SQL}, {_PENDING_MONTHLY}
SELECT snapshot_date, district, lsoa_code, {_TOTALS_SQL}, {_MEANS_SQL}, {_SHARES_SQL} FROM monthly GROUP BY 1, 2, 3""")
def _(t):
    due = _pending(t, lambda snapshots, districts=None: features.claim_plan(t.v_uc, t.v_geo, snapshots, MONTHS, districts))
    return due.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def _refreshed(t, source, rows, late):
    """Features of all snapshots, first without the late rows, then with them by way of the stored aggregates."""
    folder = scratch.shared_folder(t.spark)
    table, stored = f"{folder}/aggregates", f"{folder}/features"
    source.check(BACKFILL)
    states.refresh(source, rows.filter(~late), table, stored, BACKFILL, MONTHS)
    states.refresh(source, rows.filter(late), table, stored, BACKFILL, MONTHS)
    out = readers.read_features(t.spark, stored, source.name)
    return rounded(out.withColumn("snapshot_date", F.col("snapshot_date").cast("string")))


def _late(row: str, month):
    """Rows of 1998 on, every other one."""
    return (month >= "1998") & (F.pmod(F.xxhash64(row), F.lit(2)) == 1)


_WINDOWS_SQL = f"(SELECT strftime(snap, '%Y-%m-%d') AS snapshot_date, sales.* FROM sales JOIN {_BACKFILL_SQL} s ON date_of_transfer BETWEEN snap - INTERVAL {MONTHS} MONTH AND snap)"


@query("late_sales", _price_sql(PRICE_SQL, "snapshot_date, district, lsoa_code", _WINDOWS_SQL))
def _(t):
    late = _late("transaction_id", F.date_format("date_of_transfer", "yyyy-MM"))
    return _refreshed(t, states.sales_source(t.v_postcode, t.v_geo), t.v_price, late)


@query("late_crimes", f"""
SELECT strftime(snap, '%Y-%m-%d') AS snapshot_date, district, lsoa_code, {_CRIME_STATS_SQL}
FROM v_crime JOIN {_AREA} USING (lsoa_code) JOIN {_BACKFILL_SQL} s ON {_PENDING_MONTHS} GROUP BY 1, 2, 3""")
def _(t):
    return _refreshed(t, states.crime_source(t.v_geo, **LISTS), t.v_crime, _late("category", F.col("month")))


_ALL_CLAIMS = f"(SELECT strftime(snap, '%Y-%m-%d') AS snapshot_date, claims.* FROM claims JOIN {_BACKFILL_SQL} s ON {_PENDING_MONTHS})"
_ALL_MONTHLY = _monthly_sql(_ALL_CLAIMS).replace("PARTITION BY", "PARTITION BY snapshot_date, district,")


@query("late_claims", f"""
WITH {_CLAIMS_SQL}, {_ALL_MONTHLY}
SELECT snapshot_date, district, lsoa_code, {_TOTALS_SQL}, {_MEANS_SQL}, {_SHARES_SQL} FROM monthly GROUP BY 1, 2, 3""")
def _(t):
    return _refreshed(t, states.claim_source(t.v_geo), t.v_uc, _late("condition_group", F.col("month")))


@query("empty_months", """
WITH b AS (SELECT date_trunc('month', min(o_orderdate)) - INTERVAL 6 MONTH AS lo, date_trunc('month', max(o_orderdate)) + INTERVAL 6 MONTH AS hi FROM orders)
SELECT strftime(d, '%Y-%m') AS month FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d FROM b)
WHERE strftime(d, '%Y-%m') NOT IN (SELECT month FROM v_crime)""")
def _(t):
    ends = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    first, last = F.add_months(F.trunc("lo", "MM"), -6), F.add_months(F.trunc("hi", "MM"), 6)
    days = F.explode(F.sequence(first, last, F.make_interval(months=F.lit(1))))
    expected = ends.select(days.alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))
    return runs.empty_months(expected, t.v_crime)


@query("freshness", """
SELECT source, cadence, CAST(DATE '2024-02-01' - CAST(newest AS DATE) AS BIGINT) AS age_days, CAST(lim AS BIGINT) AS limit_days,
       (DATE '2024-02-01' - CAST(newest AS DATE)) > lim AS stale
FROM (SELECT 'sales' AS source, 'monthly' AS cadence, 28 AS lim, max(o_orderdate) AS newest FROM orders
  UNION ALL SELECT 'crime', 'annual', 365, max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'map', 'quarterly', 90, max(ts) FROM events)""")
def _(t):
    def newest(df, col, source, cadence):
        return df.agg(F.max(col).cast("timestamp_ntz").alias("newest")).select(
            F.lit(source).alias("source"), F.lit(cadence).alias("cadence"), "newest"
        )

    rows = newest(t.orders, "o_orderdate", "sales", "monthly").unionByName(newest(t.lineitem, "l_shipdate", "crime", "annual"))
    rows = rows.unionByName(newest(t.events, "ts", "map", "quarterly"))
    out = runs.freshness(rows, "2024-02-01")
    return out.withColumn("age_days", F.col("age_days").cast("long")).withColumn("limit_days", F.col("limit_days").cast("long"))


@query("combine_stored", _COMBINE_ALL_SQL)
def _(t):
    folder = scratch.shared_folder(t.spark)
    dated = [f if "snapshot_date" in f.columns else f.withColumn("snapshot_date", F.lit(SNAPSHOT).cast("date")) for f in _all_frames(t)]
    for i, frame in enumerate(dated):
        writers.write_features(frame, folder, f"source_{i}")
    stored = [readers.read_features(t.spark, folder, f"source_{i}") for i in range(len(dated))]
    return rounded(comb.combine(_spine(t), *stored, keys=features.RUN_KEYS).drop("snapshot_date"))


def _filled_sql(sql):
    return f"""SELECT district, lsoa_code, coalesce(COLUMNS(* EXCLUDE (district, lsoa_code)), 0) FROM ({sql})"""


@query("combine_written", _filled_sql(_COMBINE_ALL_SQL))
def _(t):
    """Combined, filled, checked while it is written over an older table, and read back."""
    folder = f"{scratch.shared_folder(t.spark)}/combined"
    writers.write_results(features.spine_plan(t.v_geo, [SNAPSHOT]), folder)
    made = comb.CheckedCombination(_spine(t), *_all_frames(t), keys=features.RUN_KEYS)
    writers.write_results(made.rows, folder, made.verify)
    return rounded(t.spark.read.schema(made.rows.schema).parquet(folder).drop("snapshot_date", "district_slug"))


# ---------------------------------------------------------------- sinks, read back


@query("lookup_csv", "SELECT lsoa_code_11, lsoa_code_21, lsoa_name_21, lad_name FROM v_geo")
def _(t):
    folder = scratch.shared_folder(t.spark)
    writers.write_lookup_csv(t.v_geo, folder)
    return readers.read_area_lookup(t.spark, folder).select("lsoa_code_11", "lsoa_code_21", "lsoa_name_21", "lad_name")


_MONTHLY_CRIME = "SELECT month, lsoa_code, category, outcome_status, CAST(count(*) AS BIGINT) AS crimes FROM v_crime GROUP BY 1, 2, 3, 4"


def _counted(rows):
    return rows.groupBy("month", "lsoa_code", "category", "outcome_status").agg(F.count("*").alias("crimes"))


@query("months_written", _MONTHLY_CRIME)
def _(t):
    """Months are written twice: the second write replaces its own months only."""
    folder = scratch.shared_folder(t.spark)
    writers.write_months(t.v_crime, folder)
    writers.write_months(t.v_crime.filter("month < '1995-01'"), folder)
    return _counted(readers.read_crime(t.spark, folder))


@query("months_landed", _MONTHLY_CRIME)
def _(t):
    """Files land in two rounds; the second brings late rows of months that are stored."""
    folder = scratch.shared_folder(t.spark)
    inbox, table, mark = (f"{folder}/{n}" for n in ("inbox", "table", "mark"))
    late = F.pmod(F.xxhash64("lsoa_code", "category"), F.lit(2)) == 1
    for part in (t.v_crime.filter(~late), t.v_crime.filter(late)):
        part.write.mode("append").parquet(inbox)
        landing.land_months(landing.stream_files(t.spark, inbox, part.schema), table, mark).awaitTermination()
    return _counted(readers.read_crime(t.spark, table))


@query("months_mixed", _MONTHLY_CRIME)
def _(t):
    """One table from a bulk write, landed files, a second bulk write of some months and a repeated batch."""
    folder = scratch.shared_folder(t.spark)
    inbox, table, mark = (f"{folder}/{n}" for n in ("inbox", "table", "mark"))
    early, late = F.col("month") < "1995-01", F.col("month") >= "1997-01"
    writers.write_months(t.v_crime.filter(early & (F.col("category") != "drugs")), table)
    landed = t.v_crime.filter(~early)
    landed.write.parquet(inbox)
    landing.land_months(landing.stream_files(t.spark, inbox, landed.schema), table, mark).awaitTermination()
    writers.write_months(t.v_crime.filter(early | late), table)
    month_table.append_months(landed, table, stream=mark, batch=0)
    return _counted(readers.read_crime(t.spark, table))


@query("filled_checked", f"""
SELECT id, CASE WHEN amount IS NULL OR isnan(amount) OR isinf(amount) THEN 0 ELSE amount END AS amount, coalesce(buyer, 0) AS buyer FROM {_DIRTY_SQL}""")
def _(t):
    return comb.check_filled(comb.fill(_dirty(t).drop("status"), keys=["id"]), keys=["id"])


@query("default_snapshot", "SELECT o_orderkey AS id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS snapshot_date FROM orders")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), timewin.default_snapshot(F.col("o_orderdate")).cast("date").cast("string").alias("snapshot_date"))
