"""Release comparison, coverage and null profiles."""

from pyspark.sql import functions as F

from macroloom.operators import profile, reconcile
from macroloom.showcase.joins import observations_of_orders, sidecar_of_customers
from macroloom.showcase.registry import query

# A later release of orders: urgent totals revised, high-priority statuses rewritten, failed
# orders of low priority withdrawn and pending ones renumbered.
REVISED_SQL = """
    SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN -1 - o_orderkey ELSE o_orderkey END AS k,
           o_orderpriority AS priority,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS total,
           CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS status
    FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
"""
FIRST_SQL = """
    SELECT o_orderkey AS k, o_orderpriority AS priority, o_totalprice AS total,
           CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status FROM orders
"""


def first_release(table):
    no_status = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")
    return table("orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"),
        F.when(~no_status, F.col("o_orderstatus")).alias("status"),
    )


def later_release(table):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    renumbered = (status == "P") & (priority == "5-LOW")
    return table("orders").filter(~((status == "F") & (priority == "5-LOW"))).select(
        F.when(renumbered, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("k"),
        priority.alias("priority"),
        F.when(priority == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("total"),
        F.when(~((priority == "2-HIGH") & (status == "F")), status).alias("status"),
    )


@query(f"""
    WITH a AS ({FIRST_SQL}), b AS ({REVISED_SQL}), j AS (
        SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_left, b.k IS NOT NULL AS in_right,
               a.total AS total_left, b.total AS total_right, a.status AS status_left, b.status AS status_right,
               a.k IS NOT NULL AND b.k IS NOT NULL AND a.total IS DISTINCT FROM b.total AS d_total,
               a.k IS NOT NULL AND b.k IS NOT NULL AND a.status IS NOT NULL AND a.status IS DISTINCT FROM b.status AS d_status
        FROM a FULL JOIN b ON a.k = b.k)
    SELECT k, in_left, in_right, total_left, total_right, status_left, status_right,
           CASE WHEN d_total AND d_status THEN 'total,status' WHEN d_total THEN 'total' WHEN d_status THEN 'status' ELSE '' END AS differs
    FROM j WHERE NOT in_left OR NOT in_right OR d_total OR d_status
""")
def q_parity(spark, table):
    got = reconcile.parity(first_release(table), later_release(table), ["k"], ["total", "status"], only_where_left=["status"])
    return got.withColumn("differs", F.array_join("differs", ","))


@query(f"""
    WITH a AS ({FIRST_SQL}), b AS ({REVISED_SQL})
    SELECT a.priority, count(*) AS n_overlap, count(*) FILTER (WHERE abs(a.total - b.total) > 0.5) AS n_revised,
           count(*) FILTER (WHERE abs(a.total - b.total) > 0.5) / count(*) AS share
    FROM a JOIN b ON a.k = b.k AND a.priority = b.priority GROUP BY 1
""")
def q_revision_share(spark, table):
    return reconcile.revision_share(first_release(table), later_release(table), ["k", "priority"], "total", 0.5, by=["priority"])


@query("""
    SELECT count(*) AS n_rows, count(DISTINCT p_brand) AS n_concepts, count(DISTINCT l_suppkey) AS n_areas,
           CAST(min(year(l_shipdate)) AS INTEGER) AS first_period, CAST(max(year(l_shipdate)) AS INTEGER) AS last_period
    FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def q_coverage(spark, table):
    brand = table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    df = table("lineitem").join(brand, "l_partkey").withColumn("period", F.year("l_shipdate"))
    return profile.coverage(df, "p_brand", "l_suppkey", "period")


@query("""
    SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_concepts, count(DISTINCT l_suppkey) AS n_areas,
           CAST(min(year(l_shipdate)) AS INTEGER) AS first_period, CAST(max(year(l_shipdate)) AS INTEGER) AS last_period
    FROM lineitem GROUP BY 1
""")
def q_coverage_by_release(spark, table):
    df = table("lineitem").withColumn("period", F.year("l_shipdate"))
    return profile.coverage(df, "l_partkey", "l_suppkey", "period", by=["l_returnflag"])


@query("SELECT DISTINCT p_brand, p_type FROM part")
def q_catalogue(spark, table):
    return profile.catalogue(table("part"), "p_brand", "p_type")


SIDE_CELLS_SQL = """
    SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'FY' ELSE '' END AS year_form, CASE c_mktsegment WHEN 'MACHINERY' THEN 'n/a' ELSE c_name END AS notes,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'N/A' ELSE 'date' END AS updated, c_custkey
    FROM customer WHERE c_acctbal >= 0
"""


@query(f"""
    WITH side AS ({SIDE_CELLS_SQL}), j AS (SELECT * FROM orders LEFT JOIN side ON o_custkey = c_custkey)
    SELECT 'METHODOLOGY_NOTES' AS "column", count(*) AS n_rows, count(*) - count(notes) AS n_null,
           count(*) FILTER (WHERE upper(notes) = 'N/A') AS n_na, count(notes) = 0 AS all_null FROM j
    UNION ALL SELECT 'COUNTRY_UPDATE_DATE', count(*), count(*) - count(updated), count(*) FILTER (WHERE upper(updated) = 'N/A'), count(updated) = 0 FROM j
    UNION ALL SELECT 'EMPTY', count(*), count(*), 0, true FROM j
    UNION ALL SELECT 'LATEST_ACTUAL_ANNUAL_DATA', count(*), count(*) - count(year_form), 0, count(year_form) = 0 FROM j
""")
def q_null_profile(spark, table):
    side = sidecar_of_customers(table).withColumnRenamed("COUNTRY", "REF_AREA_CODE").drop("INDICATOR", "FREQUENCY")
    merged = observations_of_orders(table).join(side, "REF_AREA_CODE", "left").withColumn("EMPTY", F.lit(None).cast("string"))
    return profile.null_profile(merged, ["METHODOLOGY_NOTES", "COUNTRY_UPDATE_DATE", "EMPTY", "LATEST_ACTUAL_ANNUAL_DATA"])


@query("SELECT count(c_custkey) / count(*) AS match_rate FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey")
def q_match_rate(spark, table):
    side = table("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return profile.match_rate(table("orders").join(side, "o_custkey", "left"), "c_name")


@query("""
    SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') / count(*) AS fiscal_share FROM customer WHERE c_acctbal >= 0
""")
def q_fiscal_share(spark, table):
    return profile.fiscal_share(sidecar_of_customers(table), "LATEST_ACTUAL_ANNUAL_DATA")


@query("""
    SELECT l_suppkey AS code, arg_min(l_returnflag || l_linestatus, l_shipdate || '|' || l_returnflag || l_linestatus) AS label
    FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1
""")
def q_first_label(spark, table):
    """Earliest usable label of every supplier, ship dates standing for releases."""
    label = F.when(F.col("l_returnflag") == "A", "").otherwise(F.concat("l_returnflag", "l_linestatus"))
    df = table("lineitem").select(F.col("l_suppkey").alias("code"), label.alias("label"), "l_shipdate")
    return profile.first_label(df, "code", "label", "l_shipdate")
