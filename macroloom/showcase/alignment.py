"""The alignment and translation pipelines as a whole."""

from pyspark.sql import functions as F

from macroloom.operators.checks import staged
from macroloom.plans.align import align_observations
from macroloom.plans.translate import translate_release
from macroloom.showcase.registry import query
from macroloom.showcase.values import EXPONENT_SQL, exponent
from macroloom.work import inline

# A feed made of lineitem. Suppliers stand for areas: the code of a supplier's nation, and for
# suppliers of nation 24 a code no list knows.
AREA_SQL = "CASE WHEN s_nationkey < 24 THEN n_name ELSE 'NOWHERE' END"


def feed(table):
    nations = table("nation").select("n_nationkey", "n_name")
    supplier = table("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_nationkey") < 24, F.col("n_name")).otherwise("NOWHERE").alias("COUNTRY")
    )
    brand = table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("INDICATOR"))
    return table("lineitem").join(supplier, "l_suppkey").join(brand, "l_partkey").select(
        "l_orderkey",
        "l_linenumber",
        "COUNTRY",
        "INDICATOR",
        F.col("l_returnflag").alias("UNIT"),
        F.col("l_linestatus").alias("FREQUENCY"),
        exponent(F.col("l_linenumber")).cast("string").alias("SCALE"),
        F.year("l_shipdate").cast("string").alias("TIME_PERIOD"),
        F.when(F.col("l_quantity") >= 5, F.col("l_extendedprice").cast("string")).alias("OBS_VALUE"),
    )


def codelists(table):
    """Code lists read off the tables: all nations, the brands of small parts, two units, one frequency."""
    nation = table("nation").select(
        F.lit("IMF.RES"), F.lit("CL_WEO_COUNTRY"), "n_name", F.concat(F.lit("Nation "), "n_nationkey").alias("label")
    )
    brand = table("part").filter("p_size < 3").groupBy("p_brand").agg(F.max("p_brand").alias("label")).select(
        F.lit("IMF.RES"), F.lit("CL_WEO_INDICATOR"), "p_brand", F.upper("label")
    )
    unit = table("lineitem").select("l_returnflag").filter("l_returnflag <> 'R'").distinct().select(
        F.lit("IMF"), F.lit("CL_UNIT"), "l_returnflag", F.concat(F.lit("Flag "), "l_returnflag")
    )
    freq = table("orders").select("o_orderstatus").filter("o_orderstatus <> 'F'").distinct().select(
        F.lit("IMF"), F.lit("CL_FREQ"), "o_orderstatus", F.concat(F.lit("Status "), "o_orderstatus")
    )
    return nation.union(brand).union(unit).union(freq).toDF("agency", "codelist_id", "code", "label")


def area_map(table):
    return table("nation").filter("n_nationkey <> 3").select(F.col("n_nationkey").alias("legacy"), F.col("n_name").alias("code"))


ALIGNED_SQL = f"""
    WITH brand AS (SELECT p_brand, upper(max(p_brand)) AS label FROM part WHERE p_size < 3 GROUP BY 1),
    freq AS (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus <> 'F'),
    feed AS (
        SELECT l_orderkey, l_linenumber, {AREA_SQL} AS area, p_brand AS concept, l_returnflag AS unit, l_linestatus AS freq,
               {EXPONENT_SQL} AS e, CAST(year(l_shipdate) AS INTEGER) AS period, l_extendedprice AS v
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 5)
    SELECT unit AS "UNIT_CODE", concept AS "CONCEPT_CODE", area AS "REF_AREA_CODE",
           CASE WHEN n_nationkey <> 3 THEN n_nationkey END AS "REF_AREA_IMF_CODE", freq AS "FREQ_CODE",
           CAST(CASE e WHEN 0 THEN 1 WHEN 6 THEN 1000000 WHEN 9 THEN 1000000000 END AS BIGINT) AS "SCALE_CODE",
           period AS "TIME_PERIOD", CASE WHEN e > 0 THEN v / pow(10.0, e) ELSE v END AS "OBS_VALUE",
           CASE WHEN unit <> 'R' THEN 'Flag ' || unit END AS "UNIT_LABEL", brand.label AS "CONCEPT_LABEL",
           'Nation ' || n_nationkey AS "REF_AREA_LABEL", 'Status ' || o_orderstatus AS "FREQ_LABEL",
           CASE e WHEN 0 THEN 'Units' WHEN 6 THEN 'Millions' WHEN 9 THEN 'Billions' END AS "SCALE_LABEL",
           l_orderkey, l_linenumber
    FROM feed LEFT JOIN nation ON n_name = area LEFT JOIN brand ON concept = p_brand LEFT JOIN freq ON freq = o_orderstatus
"""


@query(ALIGNED_SQL)
def q_align(spark, table):
    return align_observations(feed(table), codelists(table), area_map(table), keep=["l_orderkey", "l_linenumber"])


@query("""
    WITH src AS (
        SELECT o_orderkey, c_nationkey, o_orderpriority AS concept, o_orderstatus AS letter, o_totalprice AS v,
               CAST(year(o_orderdate) AS INTEGER) AS period, c_mktsegment AS notes
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 1000)
    SELECT CASE letter WHEN 'F' THEN 'PT' WHEN 'O' THEN 'IX' END AS "UNIT_CODE", concept AS "CONCEPT_CODE",
           CASE WHEN c_nationkey >= 20 THEN 'G' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') ELSE n_name END AS "REF_AREA_CODE",
           c_nationkey AS "REF_AREA_IMF_CODE", 'A' AS "FREQ_CODE", CAST(NULL AS INTEGER) AS "LASTACTUALDATE",
           CAST(1 AS BIGINT) AS "SCALE_CODE", notes AS "NOTES", period AS "TIME_PERIOD", v AS "OBS_VALUE",
           CASE letter WHEN 'F' THEN 'Percent' END AS "UNIT_LABEL", CAST(NULL AS VARCHAR) AS "CONCEPT_LABEL",
           CASE WHEN c_nationkey >= 20 THEN 'Aggregate ' || c_nationkey ELSE 'Nation ' || c_nationkey END AS "REF_AREA_LABEL",
           'Annual' AS "FREQ_LABEL", 'Units' AS "SCALE_LABEL", CAST(NULL AS TIMESTAMP) AS "COUNTRY_UPDATE_DATE", o_orderkey
    FROM src JOIN nation ON c_nationkey = n_nationkey
""")
def q_translate_release(spark, table):
    """Orders as a bulk release whose areas are nation numbers and whose units are status letters."""
    return translate_release(*bulk_orders(spark, table), check=False, keep=["o_orderkey"])


@query("""
    SELECT 'rows' AS what, count(*) AS n FROM orders WHERE o_totalprice >= 1000
    UNION ALL SELECT 'faults', 0
    UNION ALL SELECT 'null UNIT_CODE', count(*) FROM orders WHERE o_totalprice >= 1000 AND o_orderstatus = 'P'
    UNION ALL SELECT 'null UNIT_LABEL', count(*) FROM orders WHERE o_totalprice >= 1000 AND o_orderstatus <> 'F'
    UNION ALL SELECT 'null REF_AREA_CODE', 0
""")
def q_observed_counts(spark, table):
    """Unmapped and null cells of the translated release, counted while it is written."""
    _, counts = staged(translate_release(*bulk_orders(spark, table), check="flag"), "observed", "unmapped")
    shown = ["rows", "faults", "null UNIT_CODE", "null UNIT_LABEL", "null REF_AREA_CODE"]
    return inline(spark, [(name, counts[name]) for name in shown], "what string, n bigint")


def bulk_orders(spark, table):
    """Parsed rows and the four dimensions that ``translate_release`` takes."""
    customer = table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    none = F.lit(None).cast("string")
    parsed = table("orders").join(customer, "o_custkey").select(
        "o_orderkey",
        F.col("c_nationkey").alias("REF_AREA_CODE"),
        F.col("o_orderstatus").alias("UNIT_CODE"),
        F.col("o_orderpriority").alias("CONCEPT_CODE"),
        F.lit("A").alias("FREQ_CODE"),
        F.lit(None).cast("int").alias("LASTACTUALDATE"),
        F.lit(1).cast("bigint").alias("SCALE_CODE"),
        F.col("c_mktsegment").alias("NOTES"),
        F.year("o_orderdate").alias("TIME_PERIOD"),
        F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice")).alias("OBS_VALUE"),
        F.lit("own").alias("REF_AREA_LABEL"), none.alias("UNIT_LABEL"), none.alias("CONCEPT_LABEL"),
        F.lit("Annual").alias("FREQ_LABEL"), F.lit("Units").alias("SCALE_LABEL"),
    )
    made_up = F.concat(F.lit("G"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    nation = table("nation")
    areas = nation.select(
        F.col("n_nationkey").alias("legacy"), F.when(F.col("n_nationkey") >= 20, made_up).otherwise(F.col("n_name")).alias("code")
    )
    lists = nation.filter("n_nationkey < 20").select(
        F.lit("IMF.RES").alias("agency"), F.lit("CL_WEO_COUNTRY").alias("codelist_id"), F.col("n_name").alias("code"),
        F.concat(F.lit("Nation "), "n_nationkey").alias("label"),
    )
    units = inline(spark, [("IMF", "CL_UNIT", "PT", "Percent")], "agency string, codelist_id string, code string, label string")
    fallback = nation.filter("n_nationkey >= 20").select(made_up.alias("code"), F.concat(F.lit("Aggregate "), "n_nationkey").alias("label"))
    pairs = table("orders").select(F.col("o_orderpriority").alias("concept"), F.col("o_orderstatus").alias("letter")).distinct()
    unit_of = F.when(F.col("letter") == "F", "PT").when(F.col("letter") == "O", "IX")
    return parsed, lists.union(units), areas, pairs.withColumn("unit", unit_of), fallback
