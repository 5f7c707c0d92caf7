"""The serving interface over a landing root that Spark writes from the tables.

Suppliers are the flow versions of the catalogue, customers the series of the one release whose files
are landed. April 2025 and October 2024 are known bulk releases without a landed archive, so the
newest release that has data is April 2024.
"""

from pyspark.sql import functions as F

from macroloom.plans.outlook import Outlook
from macroloom.schema import BULK_RELEASES, CORRUPT_RELEASES
from macroloom.showcase.registry import query
from macroloom.sources.csvs import scan_probes
from macroloom.work import inline, new_folder

FLOWS_SQL = """
    SELECT *, k % 5 = 1 AS is_bare, CASE WHEN k % 5 = 1 THEN 'WEO' WHEN k % 5 = 2 THEN 'FSI_' || k
               ELSE 'WEO_' || (2005 + k % 19) || '_' || CASE k % 3 WHEN 0 THEN 'APR' WHEN 1 THEN 'OCT' ELSE 'JUL' END || '_VINTAGE' END AS flow_id,
           k || '.0' AS version, k % 5 = 1 OR k % 4 < 2 AS probed, k % 5 = 1 OR (k % 4 < 2 AND k % 8 <> 0) AS readable,
           make_date(2005 + (7 * k + 12) % 20, CASE WHEN (7 * k + 12) % 20 = 19 THEN 3 ELSE k % 12 + 1 END, 14) AS published
    FROM (SELECT CAST(s_suppkey AS INTEGER) AS k, s_nationkey FROM supplier)
"""
# Date forms of the probes, by the supplier's key.
FORMS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss'Z'", "M/d/yyyy", "MMMM d, yyyy", "yyyyMMdd", "d MMM yyyy"]


def flow_versions(table):
    k = F.col("k")
    year = F.lit(2005) + (k * 7 + 12) % 20
    bare = k % 5 == 1
    code = F.when(k % 3 == 0, "APR").when(k % 3 == 1, "OCT").otherwise("JUL")
    archival = F.concat(F.lit("WEO_"), k % 19 + 2005, F.lit("_"), code, F.lit("_VINTAGE"))
    day = F.make_date(year, F.when(year == 2024, 3).otherwise(k % 12 + 1), F.lit(14))
    shown = F.element_at(F.array(*[F.date_format(day, form) for form in FORMS]), (k % len(FORMS) + 1).cast("int"))
    return table("supplier").select(F.col("s_suppkey").cast("int").alias("k"), "s_nationkey").select(
        "s_nationkey",
        F.when(bare, "WEO").when(k % 5 == 2, F.concat(F.lit("FSI_"), k)).otherwise(archival).alias("flow_id"),
        F.concat(k, F.lit(".0")).alias("version"),
        (bare | (k % 4 < 2)).alias("probed"),
        F.when(bare | (k % 8 != 0), shown).otherwise("soon").alias("published"),
    )


def land_probes(table, root):
    """Probes of all flow versions in as few files as tasks: one file each would be a file operation per flow version."""
    flows = flow_versions(table).filter("probed")
    columns = [F.col("flow_id").alias("FLOW_ID"), F.col("version").alias("VERSION"), F.lit("USA").alias("COUNTRY"), F.col("published").alias("PUBLICATION_DATE")]
    flows.select(*columns).write.csv(f"{root}/probes", header=True)


def land_catalogue(table, root):
    """One catalogue document per nation."""
    flow = F.struct(F.col("flow_id").alias("id"), "version")
    lists = flow_versions(table).groupBy("s_nationkey").agg(F.array_sort(F.collect_list(flow)).alias("dataflows"))
    lists.select("s_nationkey", F.struct("dataflows").alias("data")).write.partitionBy("s_nationkey").json(f"{root}/catalogue")


def outlook(spark, table, releases=False):
    """A landing root; with ``releases`` the flow that serves April 2024 has observations and metadata."""
    root = new_folder(spark, "outlook")
    land_catalogue(table, root)
    land_probes(table, root)
    served = Outlook(spark, root)
    if not releases:
        return served
    ref = served.flow_mapping()["April", 2024]
    series = [F.concat(F.lit("C"), "c_custkey").alias("COUNTRY"), F.col("c_mktsegment").alias("INDICATOR"), F.lit("A").alias("FREQUENCY")]
    rows = table("customer")
    value = F.when(F.col("c_nationkey") != 3, F.col("c_acctbal"))
    period = [F.lit("XDC").alias("UNIT"), F.lit("0").alias("SCALE"), F.lit("2024").alias("TIME_PERIOD"), value.alias("OBS_VALUE")]
    rows.select(*series, *period).write.csv(f"{root}/observations/{ref.flow_id}/{ref.version}", header=True)
    notes = [
        F.lit("9/19/2025").alias("COUNTRY_UPDATE_DATE"), F.concat(F.lit("note "), "c_nationkey").alias("METHODOLOGY_NOTES"),
        F.concat(F.lit("FY"), F.col("c_nationkey") + 2000, F.lit("/01")).alias("LATEST_ACTUAL_ANNUAL_DATA"), F.lit("F32;F3").alias("TOPIC[]"),
    ]
    rows.filter("c_custkey % 2 = 0").select(*series, *notes).write.csv(f"{root}/metadata/{ref.flow_id}/{ref.version}", header=True)
    return served


@query(f"SELECT flow_id, version, published FROM ({FLOWS_SQL}) WHERE probed AND readable")
def q_publication_probes(spark, table):
    """Publication dates in six forms; one in eight is no date."""
    root = new_folder(spark, "probes")
    land_probes(table, root)
    return scan_probes(spark, f"{root}/probes")


MAPPING_SQL = f"""
    WITH labelled AS (
        SELECT *, CASE WHEN readable THEN CASE WHEN month(published) < 7 THEN 'April' ELSE 'October' END
                       WHEN k % 3 = 0 THEN 'April' WHEN k % 3 = 1 THEN 'October' END AS month,
               CAST(CASE WHEN readable THEN year(published) ELSE 2005 + k % 19 END AS INTEGER) AS year
        FROM ({FLOWS_SQL}) WHERE k % 5 <> 2)
    SELECT month, year, flow_id, version FROM labelled WHERE month IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY month, year ORDER BY is_bare DESC, k DESC) = 1
"""


@query(MAPPING_SQL)
def q_flow_mapping(spark, table):
    """Which flow serves which release, from the landed catalogue and probes through the published manifest."""
    mapping = outlook(spark, table).flow_mapping()
    rows = [(*release, *ref) for release, ref in mapping.items()]
    return inline(spark, rows, "month string, year int, flow_id string, version string")


def values(releases):
    return ", ".join(f"('{month}', {year})" for month, year in releases)


@query(f"""
    WITH known AS (SELECT month, year FROM ({MAPPING_SQL}) UNION SELECT * FROM (VALUES {values(BULK_RELEASES)}))
    SELECT CAST(row_number() OVER (ORDER BY year DESC, month DESC) AS INTEGER) AS position, month, year FROM known
    WHERE (month, year) NOT IN (VALUES {values(CORRUPT_RELEASES)})
""")
def q_served_versions(spark, table):
    """Releases of flows and of the bulk archive that can be served, newest first."""
    versions = outlook(spark, table).versions()
    return inline(spark, [(n, *release) for n, release in enumerate(versions, 1)], "position int, month string, year int")


REF_SQL = f"SELECT flow_id, version FROM ({MAPPING_SQL}) WHERE month = 'April' AND year = 2024"


@query(f"""
    SELECT 'April' AS month, CAST(2024 AS INTEGER) AS year, flow_id, version, count(*) AS n, CAST(round(sum(c_acctbal * 100)) AS BIGINT) AS cents
    FROM customer, ({REF_SQL}) WHERE c_nationkey <> 3 GROUP BY 3, 4
""")
def q_last_served(spark, table):
    """The newest release rolls back to the third one, which is what the call says it served."""
    served = outlook(spark, table, releases=True).serve()
    (month, year), ref = served.release, served.ref
    constants = {"month": month, "year": year, "flow_id": ref.flow_id, "version": ref.version}
    totals = served.data.agg(F.count("*").alias("n"), F.round(F.sum(F.col("OBS_VALUE") * 100)).cast("bigint").alias("cents"))
    return totals.select(*[F.lit(v).alias(c) for c, v in constants.items()], "n", "cents")


@query("""
    SELECT 'C' || c_custkey AS "REF_AREA_CODE", c_mktsegment AS "CONCEPT_CODE", CAST(2024 AS INTEGER) AS "TIME_PERIOD", c_acctbal AS "OBS_VALUE",
           CAST(CASE WHEN c_custkey % 2 = 0 THEN 2000 + c_nationkey END AS INTEGER) AS "LASTACTUALDATE",
           CASE WHEN c_custkey % 2 = 0 THEN 'note ' || c_nationkey END AS "NOTES"
    FROM customer WHERE c_nationkey <> 3
""")
def q_fetch_data(spark, table):
    """A release by its name, with what its series metadata says."""
    rows = outlook(spark, table, releases=True).fetch_data((" april", "2024"))
    return rows.select("REF_AREA_CODE", "CONCEPT_CODE", "TIME_PERIOD", "OBS_VALUE", "LASTACTUALDATE", "NOTES")


@query("""
    SELECT 'C' || c_custkey AS "REF_AREA_CODE", c_mktsegment AS "CONCEPT_CODE", 'A' AS "FREQ_CODE", 'note ' || c_nationkey AS "METHODOLOGY_NOTES",
           'FY' || (2000 + c_nationkey) || '/01' AS "LATEST_ACTUAL_ANNUAL_DATA", 'F32;F3' AS "TOPIC"
    FROM customer WHERE c_custkey % 2 = 0
""")
def q_fetch_metadata(spark, table):
    return outlook(spark, table, releases=True).fetch_series_metadata(("April", 2024))


@query("""
    SELECT 'C' || c_custkey AS "REF_AREA_CODE", c_acctbal AS "OBS_VALUE", CASE WHEN c_custkey % 2 = 0 THEN 'note ' || c_nationkey END AS "NOTES",
           CASE WHEN c_custkey % 2 = 0 THEN 'F32;F3' END AS "TOPIC"
    FROM customer WHERE c_nationkey <> 3
""")
def q_fetch_data_with_metadata(spark, table):
    """The newest release that has data, with all series metadata of the same flow version."""
    rows = outlook(spark, table, releases=True).fetch_data_with_metadata()
    return rows.select("REF_AREA_CODE", "OBS_VALUE", "NOTES", "TOPIC")
