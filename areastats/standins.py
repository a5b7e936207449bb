"""Stand-in views: the test tables given the schema of each real source.

The same SQL text runs in Spark and in the checking database, so a query and its
check start from the same rows. `{table}` is the only difference.
"""

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_geo": """
SELECT n_name AS lsoa_code_21, concat('Area ', CAST(n_nationkey AS STRING)) AS lsoa_name_21,
       CASE WHEN n_nationkey IN (23, 24) THEN 'OLD_SPLIT' WHEN n_nationkey % 6 = 0 THEN concat('OLD_', n_name) ELSE n_name END AS lsoa_code_11,
       r_name AS lad_name
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "v_postcode": """
SELECT c_custkey AS postcode, n_name AS lsoa_code FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "v_price": """
SELECT o_orderkey AS transaction_id, CAST(round(o_totalprice) AS BIGINT) AS price, o_orderdate AS date_of_transfer, o_custkey AS postcode,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'T' WHEN '2' THEN 'F' WHEN '3' THEN 'S' WHEN '4' THEN 'D' ELSE 'O' END AS property_type,
       CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS old_new,
       CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'L' END AS duration
FROM {orders}""",
    "v_crime": """
SELECT n_name AS lsoa_code, concat(CAST(year(l_shipdate) AS STRING), '-', lpad(CAST(month(l_shipdate) AS STRING), 2, '0')) AS month,
       p_type AS category, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS outcome_status
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey JOIN {part} ON l_partkey = p_partkey""",
    "v_uc": """
SELECT concat('Area ', CAST(s_nationkey AS STRING)) AS lsoa_name,
       concat(CAST(year(l_shipdate) AS STRING), '-', lpad(CAST(month(l_shipdate) AS STRING), 2, '0')) AS month,
       CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'universal_credit_no_work_required' WHEN 'AO' THEN 'universal_credit_planning_for_work'
            WHEN 'RF' THEN 'universal_credit_preparing_for_work' ELSE 'universal_credit_searching_for_work' END AS condition_group,
       CAST(sum(l_quantity) AS BIGINT) AS value
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
    "v_pop_long": """
SELECT n_name AS area_code, CASE c_custkey % 5 WHEN 0 THEN 'F0 to 15' WHEN 1 THEN 'M16 to 29' WHEN 2 THEN 'F30 to 44' WHEN 3 THEN 'M45 to 64' ELSE 'F65 and over' END AS band,
       count(*) AS people
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "v_connectivity": """
SELECT n_name AS LSOA21CD, count(*) AS stops, CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT) AS score_pence
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey GROUP BY 1""",
    "v_area": """
SELECT n_name AS area_code, CAST((n_nationkey % 5) * 2000 AS DOUBLE) AS x0, CAST(floor(n_nationkey / 5) * 2000 AS DOUBLE) AS y0, CAST(2000 AS DOUBLE) AS side FROM {nation}""",
    "v_points": """
SELECT event_id AS id, CAST((event_id * 7919) % 10000 AS DOUBLE) + 0.5 AS x, CAST((event_id * 3571) % 10000 AS DOUBLE) + 0.5 AS y,
       CASE event_type WHEN 'view' THEN 'pub' WHEN 'click' THEN 'cafe' WHEN 'purchase' THEN 'fast_food' WHEN 'signup' THEN 'school' ELSE 'bank' END AS amenity
FROM {events}""",
    "v_landuse": """
SELECT p_partkey AS id, CAST((p_partkey * 977) % 9000 AS DOUBLE) + 0.25 AS x0, CAST((p_partkey * 3571) % 9000 AS DOUBLE) + 0.25 AS y0, CAST(p_size * 10 AS DOUBLE) AS side, p_type AS landuse FROM {part}""",
    "v_lines": """
SELECT c_custkey AS id, CAST((c_custkey * 613) % 9000 AS DOUBLE) + 0.5 AS x1, CAST((c_custkey * 2971) % 9000 AS DOUBLE) + 0.5 AS y1,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(50 + c_custkey % 950 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS dx,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(50 + c_custkey % 950 AS DOUBLE) END AS dy,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'yes' ELSE 'no' END AS lit
FROM {customer}""",
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view over the parquet tables of a folder."""
    sources = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    return spark.sql(VIEWS[name].format(**sources))


def check_sql(body: str) -> str:
    """A check query with the stand-in views it names in front."""
    used = [v for v in VIEWS if v in body]
    names = {t: t for t in TABLES}
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].format(**names)})" for v in used)
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"
