"""Deriving one code vocabulary from another."""

from pyspark.sql import functions as F

from macroloom.operators import codemap
from macroloom.plans import vocabulary
from macroloom.showcase.registry import query
from macroloom.work import stored

# Suppliers are codes; each line is one value. Lines without a discount all report zero, which
# makes one value that every code shares.
VALUE_SQL = "CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END"
FEATURES = ["l_returnflag", "l_linestatus", "year"]


def left_codes(table):
    value = F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
    return table("lineitem").select(
        "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"), value.alias("value")
    )


def right_codes(table):
    """The codes renamed. Large quantities are revised, nation 9 is missing, nation 7 is there twice."""
    supplier = table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").filter("s_nationkey <> 9")
    df = left_codes(table).join(supplier, "l_suppkey")
    df = df.withColumn("value", F.when(F.col("l_quantity") > 48, -F.col("value") - 1).otherwise(F.col("value")))
    name = lambda prefix: F.concat(F.lit(prefix), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    twin = df.filter("s_nationkey = 7").withColumn("code", name("T"))
    return df.withColumn("code", name("G")).union(twin)


def both_sides(table):
    left = codemap.code_sets(left_codes(table), "l_suppkey", FEATURES, "value")
    return left, codemap.code_sets(right_codes(table), "code", FEATURES, "value")


CODES_SQL = f"""
    WITH src AS (SELECT l_suppkey, l_quantity, l_returnflag AS f0, l_linestatus AS f1, year(l_shipdate) AS f2, {VALUE_SQL} AS v FROM lineitem),
    l AS (SELECT DISTINCT l_suppkey AS code, f0, f1, f2, v FROM src),
    moved AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS k, s_nationkey, f0, f1, f2, CASE WHEN l_quantity > 48 THEN -v - 1 ELSE v END AS v
              FROM src JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey <> 9),
    r AS (SELECT DISTINCT 'G' || k AS code, f0, f1, f2, v FROM moved UNION SELECT DISTINCT 'T' || k, f0, f1, f2, v FROM moved WHERE s_nationkey = 7),
    n AS (SELECT code, count(*) AS n FROM l GROUP BY 1),
    o AS (SELECT l.code AS a, r.code AS b, count(*) AS overlap FROM l JOIN r USING (f0, f1, f2, v) GROUP BY 1, 2),
    ranked AS (SELECT a, b, n, overlap, overlap / n AS ratio, row_number() OVER (PARTITION BY a ORDER BY overlap DESC, b DESC) AS rank,
                      coalesce(lead(overlap / n) OVER (PARTITION BY a ORDER BY overlap DESC, b DESC), 0.0) AS runner_up
               FROM o JOIN n ON o.a = n.code),
    best AS (SELECT *, ratio >= 0.9 AND ratio - runner_up > 0.3 AS ok FROM ranked WHERE rank = 1)
"""


@query(CODES_SQL + """
    SELECT n.code AS code_left, n.n, CASE WHEN ok THEN b END AS code_right, CASE WHEN ok THEN overlap END AS overlap,
           CASE WHEN ok THEN ratio END AS ratio, CASE WHEN ok THEN 'mapped' WHEN a IS NOT NULL THEN 'ambiguous' ELSE 'unmatched' END AS outcome
    FROM n LEFT JOIN best ON n.code = best.a
""")
def q_code_map(spark, table):
    return codemap.score_codes(*both_sides(table))


@query(CODES_SQL + """
    SELECT ranked.a AS code_left, CAST(ranked.rank AS INTEGER) AS rank, ranked.b AS code_right, ranked.overlap, ranked.ratio
    FROM ranked JOIN best ON ranked.a = best.a WHERE NOT ok AND ranked.rank <= 3
""")
def q_code_candidates(spark, table):
    left, right = both_sides(table)
    ambiguous = stored(codemap.score_codes(left, right).filter("outcome = 'ambiguous'"), "ambiguous")
    return codemap.candidates_for(ambiguous, left, right)


@query(f"""
    SELECT l_suppkey AS code, count(DISTINCT (l_returnflag, l_linestatus, year(l_shipdate), {VALUE_SQL})) AS n FROM lineitem GROUP BY 1
""")
def q_fingerprint_size(spark, table):
    return codemap.fingerprint_sizes(codemap.fingerprint(left_codes(table), "l_suppkey", FEATURES, "value"))


@query("""
    SELECT l_returnflag, l_linestatus AS letter, CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 2 ELSE 1 END AS BIGINT) AS n_targets,
           CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'FIN' END AS target
    FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
""")
def q_unit_map(spark, table):
    """Statuses renamed; for flag A the finished ones carry two names."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]
    lines = table("lineitem").select(*keys, "l_linestatus", "l_extendedprice", "l_quantity")
    two = (F.col("l_returnflag") == "A") & (F.col("l_quantity") < 25)
    unit = F.when(F.col("l_linestatus") == "O", "OPEN").when(two, "FX").otherwise("FIN")
    return codemap.attribute_targets(
        lines.withColumnRenamed("l_linestatus", "letter"), lines.withColumn("unit", unit), keys, "l_extendedprice", ["l_returnflag"], "letter", "unit"
    )


RESOLVE_CASES = """
    CASE p_type WHEN 'LARGE' THEN 'Percent of ' || p_brand WHEN 'SMALL' THEN 'Index, 2010=100' WHEN 'ECONOMY' THEN 'Persons' ELSE lower(p_type) END"""


@query(f"""
    SELECT concept, letter, label,
           CASE WHEN concept = 'Brand#1' THEN 'USD' WHEN letter = 'LARGE' THEN 'PT' WHEN letter = 'SMALL' THEN 'IX' WHEN letter = 'ECONOMY' THEN 'PE' END AS unit,
           CASE WHEN concept = 'Brand#1' THEN 'matched' WHEN letter IN ('LARGE', 'SMALL') THEN 'label' WHEN letter = 'ECONOMY' THEN 'override'
                WHEN letter = 'PROMO' THEN 'no unit' ELSE 'unexplained' END AS source
    FROM (SELECT p_brand AS concept, p_type AS letter, min({RESOLVE_CASES}) AS label FROM part GROUP BY 1, 2)
""")
def q_unit_resolve(spark, table):
    part = table("part").select(F.col("p_brand").alias("concept"), F.col("p_type").alias("letter"))
    kind = F.col("letter")
    label = (
        F.when(kind == "LARGE", F.concat(F.lit("Percent of "), "concept")).when(kind == "SMALL", "Index, 2010=100").when(kind == "ECONOMY", "Persons")
    ).otherwise(F.lower(kind))
    pairs = part.withColumn("label", label).groupBy("concept", "letter").agg(F.min("label").alias("label"))
    matched = part.filter("concept = 'Brand#1'").distinct().withColumn("unit", F.lit("USD"))
    decided = part.filter("letter IN ('ECONOMY', 'PROMO', 'LARGE')").distinct()
    decided = decided.withColumn("unit", F.when(kind == "ECONOMY", "PE").when(kind == "LARGE", "never used"))
    return codemap.resolve_attributes(pairs, matched, decided, ["concept", "letter"])


@query("""
    SELECT l_returnflag AS concept, l_linestatus AS letter, arg_min('priced ' || l_linenumber, (year(l_shipdate), 'priced ' || l_linenumber)) AS label
    FROM lineitem GROUP BY 1, 2
""")
def q_observed_pairs(spark, table):
    """Every pair over all releases with its earliest label."""
    releases = table("lineitem").select(
        F.col("l_returnflag").alias("CONCEPT_CODE"), F.col("l_linestatus").alias("UNIT_CODE"),
        F.concat(F.lit("priced "), "l_linenumber").alias("UNIT_LABEL"),
        F.year("l_shipdate").alias("release_year"), F.lit("April").alias("release_month"),
    )
    return vocabulary.observed_pairs(releases)


@query("""
    WITH seen AS (SELECT DISTINCT n_nationkey, n_name FROM nation JOIN supplier ON n_nationkey = s_nationkey JOIN lineitem ON l_suppkey = s_suppkey),
    area AS (SELECT n_nationkey AS k, n_name AS code FROM seen WHERE n_nationkey <> 24 UNION ALL SELECT 24, 'G024')
    SELECT 'area' AS kind, CAST(k AS VARCHAR) AS key, code AS target FROM area
    UNION ALL SELECT 'inverse', code, CAST(k AS VARCHAR) FROM area
    UNION ALL SELECT 'label', 'G024', 'Nation 24' FROM seen WHERE n_nationkey = 24
    UNION ALL SELECT DISTINCT 'unit', l_returnflag || ' ' || l_linestatus, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL ELSE l_linestatus || 'X' END FROM lineitem
""")
def q_vocabulary_job(spark, table):
    """The whole derivation over lineitem. Nations are areas, years are releases, and 1998 is the
    release both sources carry; nation 24 occurs in other releases only, like the old aggregates."""
    nation = table("nation").select("n_nationkey", "n_name")
    supplier = table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("REF_AREA_CODE"))
    year = F.year("l_shipdate")
    moved = F.when((F.col("REF_AREA_CODE") == 24) & (year == 1998), 1999).otherwise(year)
    no_unit = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    releases = table("lineitem").join(supplier, "l_suppkey").select(
        "REF_AREA_CODE",
        F.concat(F.lit("Nation "), "REF_AREA_CODE").alias("REF_AREA_LABEL"),
        F.col("l_returnflag").alias("CONCEPT_CODE"),
        F.col("l_linestatus").alias("UNIT_CODE"),
        F.lit("as found").alias("UNIT_LABEL"),
        F.col("l_orderkey").alias("TIME_PERIOD"),
        F.col("l_extendedprice").alias("OBS_VALUE"),
        F.lit("April").alias("release_month"),
        moved.alias("release_year"),
        F.when(~no_unit, F.concat("l_linestatus", F.lit("X"))).alias("unit"),
    )
    api = releases.filter("release_year = 1998").join(nation, F.col("REF_AREA_CODE") == F.col("n_nationkey")).select(
        F.col("n_name").alias("REF_AREA_CODE"), "CONCEPT_CODE", F.col("unit").alias("UNIT_CODE"), "TIME_PERIOD", "OBS_VALUE"
    )
    decisions = spark.createDataFrame([("A", "F", None)], "concept string, letter string, unit string")
    tables = vocabulary.derive_vocabulary(releases.drop("unit"), api, ("April", 1998), decisions=decisions, bulk_only=(24,))
    rows = lambda name, kind, key, target: tables[name].select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), target.cast("string").alias("target"))
    return (
        rows("area_map", "area", F.col("legacy"), F.col("code"))
        .union(rows("area_map_inverse", "inverse", F.col("code"), F.col("legacy")))
        .union(rows("legacy_labels", "label", F.col("code"), F.col("label")))
        .union(rows("unit_map", "unit", F.concat_ws(" ", "concept", "letter"), F.col("unit")))
    )
