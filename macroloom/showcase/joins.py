"""Lookups, strict translation and metadata joins."""

from pyspark.sql import functions as F

from macroloom.operators import codemap, lookup, metadata
from macroloom.showcase.registry import query

PAIR = {"l_returnflag": "flag", "l_linestatus": "status"}


def known_pairs(table):
    """Unit of every (flag, status) pair of lineitem; flag A has none."""
    pairs = table("lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).distinct()
    return pairs.withColumn("unit", F.when(F.col("flag") != "A", F.concat("flag", F.lit("-"), "status")))


@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name, n_name, r_name
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
""")
def q_label_lookup(spark, table):
    df = table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    df = lookup.lookup(df, table("supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "s_name", "s_nationkey": "nation"})
    df = lookup.lookup(df, table("nation"), {"nation": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "region"})
    df = lookup.lookup(df, table("region"), {"region": "r_regionkey"}, {"r_name": "r_name"})
    return df.select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "n_name", "r_name")


@query("""
    SELECT c_custkey, c_nationkey, CASE WHEN n_regionkey <> 2 THEN n_regionkey END AS legacy
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def q_back_lookup(spark, table):
    dim = table("nation").filter("n_regionkey <> 2")
    return lookup.lookup(table("customer").select("c_custkey", "c_nationkey"), dim, {"c_nationkey": "n_nationkey"}, {"n_regionkey": "legacy"})


@query("""
    SELECT c_custkey, n_name AS "REF_AREA_CODE", c_nationkey AS "REF_AREA_IMF_CODE" FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_translate_area(spark, table):
    df = table("customer").select("c_custkey", F.col("c_nationkey").alias("REF_AREA_CODE"), F.col("c_nationkey").alias("REF_AREA_IMF_CODE"))
    return lookup.strict_lookup(df, table("nation"), {"REF_AREA_CODE": "n_nationkey"}, {"n_name": "REF_AREA_CODE"}, "nations", check=False)


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
           CASE WHEN l_returnflag <> 'A' THEN l_returnflag || '-' || l_linestatus END AS unit
    FROM lineitem
""")
def q_translate_unit(spark, table):
    df = table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return lookup.strict_lookup(df, known_pairs(table), PAIR, {"unit": "unit"}, "(flag, status) pairs")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'A'")
def q_unmapped(spark, table):
    return lookup.unmapped(table("lineitem"), known_pairs(table).filter("unit is not null"), PAIR)


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag <> 'A'")
def q_mapped(spark, table):
    df = table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return lookup.mapped(df, known_pairs(table).filter("unit is not null"), PAIR)


@query("""
    SELECT s_suppkey, s_nationkey,
           CASE WHEN s_nationkey < 10 THEN n_name WHEN s_nationkey < 20 THEN 'fallback ' || s_nationkey END AS label
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_label_fallback(spark, table):
    df = table("supplier").select("s_suppkey", "s_nationkey", F.lit("own label").alias("label"))
    nation = table("nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    fallback = nation.filter("code < 20").select("code", F.concat(F.lit("fallback "), "code").alias("label"))
    return lookup.label_with_fallback(df, nation.filter("code < 10"), fallback, "s_nationkey", "label")


@query("""
    SELECT p_partkey, p_type AS "TOPIC", 'Topic ' || lower(p_type) AS topic_label FROM part
""")
def q_coded_column(spark, table):
    """A metadata column labelled by the code list that carries its name."""
    part = table("part").select("p_partkey", F.col("p_type").alias("TOPIC"))
    own = part.select(F.lit("IMF.RES").alias("agency"), F.lit("CL_TOPIC").alias("codelist_id"), F.col("TOPIC").alias("code")).distinct()
    codes = own.withColumn("label", F.concat(F.lit("Topic "), F.lower("code")))
    other = codes.withColumns({"codelist_id": F.lit("CL_OTHER"), "label": F.lit("wrong")})
    return lookup.coded_column_label(part, codes.union(other), "TOPIC", "topic_label")


@query("SELECT n_name AS code, n_nationkey AS legacy FROM nation")
def q_inverse(spark, table):
    mapping = table("nation").select(F.col("n_nationkey").alias("legacy"), F.col("n_name").alias("code"))
    return lookup.strict_inverse(mapping, "legacy", "code")


@query("SELECT n_regionkey AS region, count(*) AS n FROM nation GROUP BY 1 HAVING count(*) > 1")
def q_shared_targets(spark, table):
    return lookup.shared_targets(table("nation").select("n_nationkey", F.col("n_regionkey").alias("region")), "region")


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_dup_keys(spark, table):
    return metadata.repeated_keys(table("lineitem"), ["l_orderkey", "l_partkey"])


# -- series metadata: orders are the observations, customers carry their metadata

SIDECAR_SQL = f"""
    SELECT c_custkey, 1980 + c_nationkey AS last_year, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS notes,
           CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN make_timestamp(2025, 1 + c_nationkey % 12, 1 + c_nationkey, 0, 0, 0) END AS updated
    FROM customer WHERE c_acctbal >= 0
"""


def observations_of_orders(table):
    return table("orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("REF_AREA_CODE"),
        F.lit("TOTAL").alias("CONCEPT_CODE"),
        F.lit("A").alias("FREQ_CODE"),
        F.year("o_orderdate").alias("release_year"),
        F.col("o_totalprice").alias("OBS_VALUE"),
    )


def sidecar_of_customers(table):
    year = F.col("c_nationkey") + 1980
    fiscal = F.concat(F.lit("FY"), year, F.lit("/"), F.right((year + 1).cast("string"), F.lit(2)))
    segment = F.col("c_mktsegment")
    updated = F.concat_ws("/", F.col("c_nationkey") % 12 + 1, F.col("c_nationkey") + 1, F.lit(2025))
    return table("customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("COUNTRY"),
        F.lit("TOTAL").alias("INDICATOR"),
        F.lit("A").alias("FREQUENCY"),
        F.when(segment == "BUILDING", fiscal).otherwise(year.cast("string")).alias("LATEST_ACTUAL_ANNUAL_DATA"),
        F.when(segment == "MACHINERY", "n/a").otherwise(F.col("c_name")).alias("METHODOLOGY_NOTES"),
        F.when(segment == "AUTOMOBILE", "N/A").otherwise(updated).alias("COUNTRY_UPDATE_DATE"),
    )


@query(f"""
    WITH side AS ({SIDECAR_SQL})
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "REF_AREA_CODE", 'TOTAL' AS "CONCEPT_CODE", 'A' AS "FREQ_CODE",
           CAST(year(o_orderdate) AS INTEGER) AS release_year, o_totalprice AS "OBS_VALUE",
           CAST(last_year AS INTEGER) AS "LASTACTUALDATE", notes AS "NOTES", updated AS "COUNTRY_UPDATE_DATE"
    FROM orders LEFT JOIN side ON o_custkey = c_custkey
""")
def q_meta_join(spark, table):
    return metadata.attach_series_metadata(observations_of_orders(table), sidecar_of_customers(table))


@query(f"""
    WITH side AS ({SIDECAR_SQL})
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "REF_AREA_CODE", 'TOTAL' AS "CONCEPT_CODE", 'A' AS "FREQ_CODE",
           CAST(year(o_orderdate) AS INTEGER) AS release_year, o_totalprice AS "OBS_VALUE",
           CAST(last_year AS INTEGER) AS "LASTACTUALDATE", notes AS "NOTES", updated AS "COUNTRY_UPDATE_DATE"
    FROM orders LEFT JOIN side ON o_custkey = c_custkey AND year(o_orderdate) <> 1997
""")
def q_meta_releases(spark, table):
    """Seven releases in one join. The metadata of 1997 repeats its keys, so 1997 gets none."""
    facts = observations_of_orders(table)
    wanted = facts.select("release_year", F.col("REF_AREA_CODE").alias("COUNTRY")).distinct()
    side = wanted.join(sidecar_of_customers(table), "COUNTRY")
    side = side.unionByName(side.filter("release_year = 1997"))
    return metadata.attach_series_metadata(facts, side, scope=["release_year"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def q_meta_collision(spark, table):
    facts = table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    meta = table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", F.col("c_mktsegment").alias("o_orderstatus"))
    return metadata.merge_public_metadata(facts, meta, keys=("o_custkey",))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS "REF_AREA_CODE", 'TOTAL' AS "CONCEPT_CODE", 'A' AS "FREQ_CODE",
           CASE c_mktsegment WHEN 'BUILDING' THEN 'FY' || (1980 + c_nationkey) || '/' || right(CAST(1981 + c_nationkey AS VARCHAR), 2)
                ELSE CAST(1980 + c_nationkey AS VARCHAR) END AS "LATEST_ACTUAL_ANNUAL_DATA",
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'n/a' ELSE c_name END AS "METHODOLOGY_NOTES"
    FROM customer WHERE c_acctbal >= 0
""")
def q_public_metadata(spark, table):
    side = sidecar_of_customers(table).withColumns({"UNIT": F.lit("B"), "SCALE": F.lit("9")})
    return metadata.public_metadata(side)


@query(f"""
    WITH side AS ({SIDECAR_SQL})
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "REF_AREA_CODE", 'TOTAL' AS "CONCEPT_CODE", 'A' AS "FREQ_CODE",
           CAST(year(o_orderdate) AS INTEGER) AS release_year, o_totalprice AS "OBS_VALUE",
           CAST(CASE WHEN year(o_orderdate) IN (1996, 1999) THEN last_year ELSE 2001 END AS INTEGER) AS "LASTACTUALDATE",
           CASE WHEN year(o_orderdate) IN (1996, 1999) THEN notes END AS "NOTES",
           CASE WHEN year(o_orderdate) IN (1996, 1999) THEN updated END AS "COUNTRY_UPDATE_DATE"
    FROM orders LEFT JOIN side ON o_custkey = c_custkey
""")
def q_degraded_repair(spark, table):
    """Releases 1996 and 1999 lost their metadata and get it back; the others keep what they have."""
    facts = observations_of_orders(table)
    lost = F.col("release_year").isin(1996, 1999)
    facts = facts.withColumns({
        "LASTACTUALDATE": F.when(~lost, F.lit(2001)), "NOTES": F.lit(None).cast("string"),
        "COUNTRY_UPDATE_DATE": F.lit(None).cast("timestamp_ntz"),
    })
    wanted = facts.select("release_year", F.col("REF_AREA_CODE").alias("COUNTRY")).distinct()
    side = wanted.join(sidecar_of_customers(table), "COUNTRY")
    return metadata.repair_degraded_releases(facts, side, ["release_year"])


@query("""
    SELECT DISTINCT l_suppkey AS code FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
      AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
""")
def q_missing_codes(spark, table):
    supplier = table("supplier")
    codes = table("lineitem").select(F.col("l_suppkey").alias("code"))
    return codemap.missing_codes(codes, supplier.filter("s_acctbal >= 0").select("s_suppkey"), supplier.filter("s_nationkey = 3").select("s_suppkey"))
