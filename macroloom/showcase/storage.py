"""Scans, snapshots and streaming over files that Spark writes from the tables.

Everything is written below the folder named by ``spark.checkpoint.dir``.
"""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from macroloom.operators.lookup import lookup
from macroloom.operators.metadata import newest_per_key
from macroloom.plans.align import align_observations
from macroloom.showcase.alignment import ALIGNED_SQL, area_map, codelists, feed
from macroloom.showcase.documents import series_text
from macroloom.showcase.registry import query
from macroloom.sources import bucketed, csvs, json_docs, snapshots, text_lines, xml_docs
from macroloom.streaming.ingest import compact_ingested, ingest_stream, landed_stream, read_ingested
from macroloom.work import new_folder, stored

CSV_STYLE = {"header": "true", "escape": '"', "emptyValue": ""}


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang FROM documents
""")
def q_csv_scan(spark, table):
    """Texts with quotes, commas and line breaks, through CSV files and back; half of the files have another order of columns."""
    lang = F.when(F.col("lang") == "en", "n/a").otherwise(F.col("lang"))
    docs = table("documents").select("doc_id", "text", lang.alias("lang"))
    folders = [new_folder(spark, "csv"), new_folder(spark, "csv")]
    english = F.coalesce(F.col("lang") == "n/a", F.lit(False))
    docs.filter(english).write.options(**CSV_STYLE).csv(folders[0])
    docs.filter(~english).select("lang", "doc_id", "text").write.options(**CSV_STYLE).csv(folders[1])
    return csvs.scan_observations(spark, folders)


@query("SELECT 'agency=' || c_nationkey AS agency, CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS label FROM customer")
def q_codelist_scan(spark, table):
    """One landed code list document per nation, with its customers as codes; file names are Spark's own."""
    folder = new_folder(spark, "codelists")
    entry = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("name"))
    lists = table("customer").groupBy(F.col("c_nationkey").alias("agency")).agg(F.collect_list(entry).alias("codes"))
    message = F.struct(F.array(F.struct("codes")).alias("codelists")).alias("data")
    lists.select("agency", message).write.partitionBy("agency").json(folder)
    return json_docs.scan_codelists(spark, folder).select("agency", "code", "label")


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS pos, n_name AS flow_id, CAST(n_regionkey AS VARCHAR) AS version FROM nation")
def q_catalogue_scan(spark, table):
    """A landed catalogue document that lists every nation as a dataflow."""
    folder = new_folder(spark, "catalogue")
    flow = F.struct("n_nationkey", F.col("n_name").alias("id"), F.col("n_regionkey").cast("string").alias("version"))
    flows = F.array_sort(F.collect_list(flow)).alias("dataflows")
    table("nation").agg(flows).select(F.struct("dataflows").alias("data")).write.json(folder)
    return json_docs.scan_catalogue(spark, folder)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS "COUNTRY", 'n/a' AS "INDICATOR", CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS "TOPIC" FROM customer
""")
def q_sidecar_scan(spark, table):
    folder = new_folder(spark, "sidecar")
    topic = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    table("customer").select(
        F.lit("dataflow").alias("STRUCTURE[;]"), F.lit(1).alias("OBS_VALUE"),
        F.col("c_custkey").alias("COUNTRY"), F.lit("n/a").alias("INDICATOR"), topic.alias("TOPIC[]"),
    ).write.options(**CSV_STYLE).csv(folder)
    return csvs.scan_sidecar(spark, folder)


@query("""
    SELECT 'C' || c_custkey AS "CONCEPT", c_mktsegment AS "UNIT", '1' AS "TIME_PERIOD", c_acctbal AS value FROM customer
    UNION ALL SELECT 'C' || c_custkey, c_mktsegment, '2', c_nationkey FROM customer
""")
def q_xml_scan(spark, table):
    """Series elements in files that are split between tasks."""
    folder = new_folder(spark, "xml")
    xml = series_text(F.concat(F.lit("C"), "c_custkey"), F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment"))
    table("customer").select(xml.alias("value")).write.text(folder)
    return xml_docs.scan_series(spark, folder).select("CONCEPT", "UNIT", "TIME_PERIOD", F.col("OBS_VALUE").cast("double").alias("value"))


@query("SELECT o_orderstatus AS status, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS line_no FROM orders")
def q_lines_scan(spark, table):
    """One text folder per status with ordered files: line numbers continue over blocks of a file."""
    folder = new_folder(spark, "lines")
    ordered = table("orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value"), "o_orderkey")
    # Sorted by the folder's column first: the writer would otherwise sort by that alone, which undoes an order by key.
    ordered = ordered.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderstatus", "o_orderkey")
    ordered.select("o_orderstatus", "value").write.partitionBy("o_orderstatus").text(folder)
    lines = text_lines.scan_lines(spark, folder).select(
        F.regexp_extract("file", "o_orderstatus=([A-Z])", 1).alias("status"), "file", "line_no", F.col("value").cast("bigint").alias("o_orderkey")
    )
    # Files of a status follow each other in key order; their sizes turn positions in a file into positions overall.
    per_file = lines.groupBy("status", "file").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))
    earlier = Window.partitionBy("status").orderBy("first_key").rowsBetween(Window.unboundedPreceding, -1)
    before = per_file.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return lines.join(before, "file").select("status", "o_orderkey", (F.col("line_no") + F.col("before")).alias("line_no"))


@query("""
    WITH m AS (SELECT max(ts) AS now FROM events), newest AS (
        SELECT user_id, max(ts) AS ts FROM events GROUP BY 1)
    SELECT e.user_id, e.event_id, e.ts AS ingested_at, e.event_type FROM events e JOIN newest n ON e.user_id = n.user_id AND e.ts = n.ts, m
    WHERE e.ts > m.now - INTERVAL 1 DAY
""")
def q_fresh_snapshot(spark, table):
    """Newest event of every user, where it is younger than a day at the end of the stream."""
    events = table("events").select("user_id", "event_id", F.col("ts").alias("ingested_at"), "event_type")
    now = events.agg(F.max("ingested_at")).first()[0]
    newest = newest_per_key(events, ["user_id"], ["ingested_at", "event_id"])
    return snapshots.fresh(newest, snapshots.DAY, F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS release_year, '9.1' AS flow_version, '1' AS schema_version,
           CASE WHEN year(l_shipdate) = 1996 THEN l_extendedprice * 2 ELSE l_extendedprice END AS "OBS_VALUE"
    FROM lineitem WHERE year(l_shipdate) < 1999 AND l_returnflag = 'A'
""")
def q_snapshot_store(spark, table):
    """All releases are stored under two schema versions, one partition is replaced, and one flow version is read back."""
    store = new_folder(spark, "store")
    version = F.when(F.col("l_returnflag") == "A", "9.1").when(F.col("l_returnflag") == "R", "9.10").otherwise("9.2")
    lines = table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("OBS_VALUE"), F.year("l_shipdate").alias("release_year"), version.alias("flow_version")
    )
    parts = ["release_year", "flow_version", "schema_version"]
    for schema in ("1", "2"):
        snapshots.write_snapshot(lines.withColumn("schema_version", F.lit(schema)), store, parts, ["l_orderkey"])
    revised = lines.filter("release_year = 1996 AND flow_version = '9.1'").withColumn("OBS_VALUE", F.col("OBS_VALUE") * 2)
    snapshots.write_snapshot(revised.withColumn("schema_version", F.lit("1")), store, parts, ["l_orderkey"])
    return snapshots.read_snapshot(spark, store, flow_version="9.1", schema_version="1").filter("release_year < 1999").drop("ingested_at")


@query("""
    SELECT l_orderkey, l_linenumber, s_nationkey, CAST(CASE WHEN s_nationkey = 3 THEN NULL ELSE 'note ' || s_nationkey END AS VARCHAR) AS notes
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
""")
def q_colocated_join(spark, table):
    """Lines and suppliers stored in the same buckets and joined without an exchange; one table is opened anew."""
    buckets, names = 16, [f"macroloom_{kind}_{uuid.uuid4().hex}" for kind in ("lines", "suppliers", "again")]
    folders = [new_folder(spark, "bucketed"), new_folder(spark, "bucketed")]
    note = F.when(F.col("s_nationkey") != 3, F.concat(F.lit("note "), "s_nationkey"))
    dim = table("supplier").select(F.col("s_suppkey").alias("series"), "s_nationkey", note.alias("notes"))
    facts = bucketed.write_bucketed(table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("series")), folders[0], names[0], ["series"], buckets)
    bucketed.write_bucketed(dim, folders[1], names[1], ["series"], buckets)
    again = bucketed.open_bucketed(spark, folders[1], names[2], ["series"], buckets)
    joined = lookup(facts, again.hint("merge"), {"series": "series"}, {"s_nationkey": "s_nationkey", "notes": "notes"})
    return joined.drop("series")


@query("SELECT event_id, user_id, 'sdr' AS sublayer FROM events WHERE event_type IN ('signup', 'error')")
def q_clear_scope(spark, table):
    """Snapshots of one scope are cleared and those of the other stay."""
    store = new_folder(spark, "scopes")
    reserve = F.col("event_type").isin("signup", "error")
    rows = table("events").select("event_id", "user_id")
    for sublayer, chosen in (("sdr", reserve), ("weo_api", ~reserve)):
        part = table("events").filter(chosen).select(*rows.columns)
        snapshots.write_snapshot(snapshots.keyed(part, sublayer=sublayer, release=("April", 2024)), store)
    snapshots.clear_snapshots(spark, store, "weo")
    return snapshots.read_snapshot(spark, store, sublayer="sdr").select("event_id", "user_id", "sublayer")


OBSERVATION = ["l_orderkey", "l_linenumber", "REF_AREA_CODE", "CONCEPT_CODE", "UNIT_CODE", "TIME_PERIOD"]


@query(f"""
    SELECT l_orderkey, l_linenumber, "REF_AREA_CODE", "CONCEPT_LABEL", "TIME_PERIOD",
           CASE WHEN "TIME_PERIOD" = 1996 THEN "OBS_VALUE" * 2 ELSE "OBS_VALUE" END AS "OBS_VALUE" FROM ({ALIGNED_SQL})
""")
def q_stream_ingest(spark, table):
    """Landed files go through the alignment pipeline as a stream; one year is landed again with other values; each run is compacted."""
    landing, store, checkpoint = (new_folder(spark, purpose) for purpose in ("landing", "stream", "progress"))
    rows = feed(table)
    lists, areas = stored(codelists(table), "codelists"), stored(area_map(table), "areas")

    def transform(batch):
        aligned = align_observations(batch, lists, areas, keep=["l_orderkey", "l_linenumber"])
        return aligned.withColumn("release_year", F.col("TIME_PERIOD"))

    restated = rows.filter("TIME_PERIOD = '1996'").withColumn("OBS_VALUE", (F.col("OBS_VALUE").cast("double") * 2).cast("string"))
    for landed in (rows, restated):
        landed.write.mode("append").parquet(landing)
        stream = landed_stream(spark, landing, rows.schema, "parquet")
        ingest_stream(stream, transform, store, checkpoint, ["release_year"], ["l_orderkey"]).awaitTermination()
        compact_ingested(spark, store, OBSERVATION, ["l_orderkey"])
    newest = read_ingested(spark, store, OBSERVATION)
    return newest.select("l_orderkey", "l_linenumber", "REF_AREA_CODE", "CONCEPT_LABEL", "TIME_PERIOD", "OBS_VALUE")
