"""Flow discovery, precedence, served releases, roll-back, landed paths."""

from pyspark.sql import functions as F

from macroloom.functions.dates import release_month
from macroloom.operators import releases
from macroloom.showcase.registry import query

# Parts as a catalogue of flows: large parts are bare flows, small ones archival, tiny ones others.
FLOWS_SQL = """
    SELECT p_partkey AS pos, CASE WHEN p_size > 45 THEN 'WEO' WHEN p_size > 5 THEN 'WEO_' || (2000 + p_size % 20) || '_' ||
               CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'APR' WHEN p_type = 'ECONOMY' THEN 'JUL' ELSE 'OCT' END || '_VINTAGE'
               ELSE 'FSI_' || p_size END AS flow_id,
           p_partkey || '.' || p_size || '.0' AS version, p_partkey, p_size, p_type, p_brand
    FROM part
"""
# Publication day of every bare flow and of the archival flows of three brands.
PROBED_SQL = "p_size > 5 AND (p_size > 45 OR p_brand IN ('Brand#1', 'Brand#2', 'Brand#3'))"


def flows(table):
    size, kind = F.col("p_size"), F.col("p_type")
    month = F.when(kind.isin("LARGE", "SMALL"), "APR").when(kind == "ECONOMY", "JUL").otherwise("OCT")
    archival = F.concat(F.lit("WEO_"), size % 20 + 2000, F.lit("_"), month, F.lit("_VINTAGE"))
    flow = F.when(size > 45, "WEO").when(size > 5, archival).otherwise(F.concat(F.lit("FSI_"), size))
    return table("part").select(
        F.col("p_partkey").alias("pos"), flow.alias("flow_id"), F.concat_ws(".", "p_partkey", "p_size", F.lit("0")).alias("version"),
        "p_size", "p_type", "p_brand",
    )


def probes(table):
    known = (F.col("p_size") > 45) | F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    day = F.make_date(F.col("p_size") % 20 + 2000, F.col("p_size") % 12 + 1, F.lit(14))
    return flows(table).filter((F.col("p_size") > 5) & known).select("flow_id", "version", day.alias("published"))


@query(f"""
    SELECT pos, flow_id, version FROM ({FLOWS_SQL}) WHERE p_size > 5
""")
def q_candidate_flows(spark, table):
    return releases.candidate_flows(flows(table).select("pos", "flow_id", "version"))


LABELLED_SQL = f"""
    SELECT pos, flow_id, version, flow_id = 'WEO' AS is_bare, {PROBED_SQL} AS probed,
           CASE WHEN {PROBED_SQL} THEN CASE WHEN p_size % 12 + 1 < 7 THEN 'April' ELSE 'October' END
                WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type IN ('LARGE', 'SMALL') THEN 'April' ELSE 'October' END AS month,
           CASE WHEN {PROBED_SQL} OR p_type <> 'ECONOMY' THEN CAST(2000 + p_size % 20 AS INTEGER) END AS year
    FROM ({FLOWS_SQL}) WHERE p_size > 5
"""


@query(LABELLED_SQL)
def q_flow_labels(spark, table):
    return releases.label_flows(releases.candidate_flows(flows(table)), probes(table))


@query(f"""
    WITH labelled AS ({LABELLED_SQL})
    SELECT month, year, flow_id, version FROM labelled WHERE month IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY month, year ORDER BY is_bare DESC, list_transform(string_split(version, '.'), lambda x: CAST(x AS INTEGER)) DESC, pos) = 1
""")
def q_flow_precedence(spark, table):
    return releases.preferred_flow(releases.label_flows(releases.candidate_flows(flows(table)), probes(table)))


HALF = "CASE WHEN month({c}) < 7 THEN 'April' ELSE 'October' END AS month, CAST(year({c}) AS INTEGER) AS year"
SERVED_SQL = f"""
    SELECT {HALF.format(c="o_orderdate")} FROM orders UNION SELECT {HALF.format(c="l_shipdate")} FROM lineitem
    EXCEPT SELECT {HALF.format(c="o_orderdate")} FROM orders WHERE year(o_orderdate) IN (1996, 2000) AND month(o_orderdate) < 7
"""


def halves(df, column):
    return df.select(release_month(F.col(column)).alias("month"), F.year(column).alias("year"))


def served(table):
    orders, lines = halves(table("orders"), "o_orderdate"), halves(table("lineitem"), "l_shipdate")
    corrupt = orders.filter("month = 'April' AND year IN (1996, 2000)")
    return releases.served_releases(orders, lines, corrupt)


@query(f"SELECT month, year FROM ({SERVED_SQL})")
def q_versions(spark, table):
    return releases.newest_first(served(table))


@query(f"SELECT month, year FROM ({SERVED_SQL}) ORDER BY year DESC, month DESC LIMIT 1")
def q_latest(spark, table):
    return releases.latest(served(table))


@query(f"SELECT month, year FROM ({SERVED_SQL}) WHERE year < 2000 OR (year = 2000 AND month = 'April') ORDER BY year DESC, month DESC LIMIT 3")
def q_rollback(spark, table):
    """The three releases to try after October 2000 failed."""
    return releases.roll_back_candidates(served(table), ("October", 2000))


@query("""
    WITH r AS (SELECT DISTINCT CASE WHEN month(o_orderdate) < 7 THEN 'April' ELSE 'October' END AS month, CAST(year(o_orderdate) + 24 AS INTEGER) AS year FROM orders),
    n AS (SELECT month, year, '/' || year || '/' AS folder, 'weo' || CASE month WHEN 'April' THEN 'apr' ELSE 'oct' END || year || '-sdmxdata.zip' AS name FROM r)
    SELECT month, year,
           CASE WHEN year IN (2019, 2021, 2023) THEN folder || name
                WHEN year IN (2020, 2022) THEN folder || CASE month WHEN 'April' THEN '01/' ELSE '02/' END || name END AS path,
           CASE WHEN year < 2024 THEN 'found' WHEN year = 2024 THEN 'error' ELSE 'no data' END AS outcome
    FROM n
""")
def q_path_candidates(spark, table):
    """Landed paths made from orders: odd years at the plain path, even ones at the numbered path,
    2024 refused at the first path tried, later years not landed."""
    wanted = halves(table("orders"), "o_orderdate").withColumn("year", F.col("year") + 24).distinct()
    year, april = F.col("year"), F.col("month") == "April"
    name = F.concat(F.lit("weo"), F.when(april, "apr").otherwise("oct"), year, F.lit("-sdmxdata.zip"))
    folder = F.concat(F.lit("/"), year, F.lit("/"))
    path = (
        F.when(year == 2024, F.concat(folder, F.lower("month"), F.lit("/"), name))
        .when(year % 2 == 1, F.concat(folder, name))
        .otherwise(F.concat(folder, F.when(april, "01/").otherwise("02/"), name))
    )
    manifest = wanted.filter(year <= 2024).select(path.alias("path"), F.when(year == 2024, 403).otherwise(206).alias("status"))
    plain_of_2024 = wanted.filter(year == 2024).select(F.concat(folder, name).alias("path"), F.lit(200).alias("status"))
    return releases.first_existing_path(wanted, manifest.union(plain_of_2024))
