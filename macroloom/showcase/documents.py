"""JSON, XML, XSD, HTML and archives, all made from table rows by Spark itself."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from macroloom.functions.text import count_opened, element_text, html_segments, nth_element
from macroloom.plans.bulk import parse_with_report
from macroloom.schema import BULK_CODELISTS
from macroloom.sources import archives, json_docs, pages, xml_docs
from macroloom.showcase.registry import query
from macroloom.work import spread


@query("""
    SELECT event_id, 'k' || json_extract_string(props, '$.k') AS code, event_type AS label FROM events
    UNION ALL SELECT event_id, 'named', CASE WHEN event_type = 'view' THEN 'english' ELSE '' END FROM events
""")
def q_codelist_json(spark, table):
    """A code list message per event: an older list, a null id, a repeated id, a label by language."""
    message = F.concat(
        F.lit('{"codelists":[{"codes":[{"id":"old","name":"old"}]},{"codes":[{"name":"no id"},{"id":"k'),
        F.get_json_object("props", "$.k"),
        F.lit('","name":"earlier"},{"id":"named"'),
        F.when(F.col("event_type") == "view", F.lit(',"names":{"en":"english"}')).otherwise(F.lit("")),
        F.lit('},{"id":"k'),
        F.get_json_object("props", "$.k"),
        F.lit('","name":"'),
        F.col("event_type"),
        F.lit('"}]}]}'),
    )
    parsed = F.from_json(message, json_docs.CODELIST_MESSAGE)
    codes = spread(table("events").select("event_id", "event_type", "props")).select("event_id", json_docs.codes_of(parsed).alias("codes"))
    return json_docs.explode_codes(codes, ["event_id"], F.col("codes"))


def series_text(key, price, quantity, flag):
    return F.concat(
        F.lit('<Series UNIT="'), flag, F.lit('" CONCEPT="'), key, F.lit('" REF_AREA="111" FREQ="A" SCALE="1" NOTES="">'),
        F.lit('<Obs TIME_PERIOD="1" OBS_VALUE="'), price, F.lit('"/><Obs TIME_PERIOD="2" OBS_VALUE="'), quantity, F.lit('"/></Series>'),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag AS unit, 'L' || l_partkey AS concept, CAST('1' AS VARCHAR) AS period, l_extendedprice AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, 'L' || l_partkey, '2', l_quantity FROM lineitem
""")
def q_xml_roundtrip(spark, table):
    xml = series_text(F.concat(F.lit("L"), "l_partkey"), F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_returnflag"))
    lines = spread(table("lineitem").select("l_orderkey", "l_linenumber", xml.alias("xml")))
    parsed = lines.select("l_orderkey", "l_linenumber", xml_docs.parse_series(F.col("xml")).alias("s"))
    rows = xml_docs.series_to_rows(parsed.select("l_orderkey", "l_linenumber", "s.*"), keep=["l_orderkey", "l_linenumber"])
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("UNIT").alias("unit"), F.col("CONCEPT").alias("concept"),
        F.col("TIME_PERIOD").alias("period"), F.col("OBS_VALUE").cast("double").alias("value"),
    )


@query("SELECT p_partkey, 'CL_' || p_size AS codelist_id, p_brand AS code, p_name AS label FROM part")
def q_xsd_codes(spark, table):
    xml = F.concat(
        F.lit('<xs:simpleType name="CL_'), "p_size", F.lit('"><xs:restriction base="xs:string"><xs:enumeration value="'), "p_brand",
        F.lit('"><xs:annotation><xs:documentation xml:lang="en">replaced</xs:documentation></xs:annotation></xs:enumeration>'),
        F.lit('<xs:enumeration value="'), "p_brand", F.lit('"><xs:annotation><xs:documentation>'), "p_name",
        F.lit("</xs:documentation></xs:annotation></xs:enumeration></xs:restriction></xs:simpleType>"),
    )
    parsed = table("part").select("p_partkey", xml_docs.parse_simple_type(xml).alias("t"))
    return xml_docs.enumerations(parsed.select("p_partkey", "t.*"), keep=["p_partkey"])


@query(r"""
    SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>.*?</li\s*>')[1] IS NOT NULL AS has_item,
           trim(regexp_replace(regexp_extract_all(html, '(?is)<title\b[^>]*>.*?</title\s*>')[1], '(?s)<[^>]*>', '', 'g')) AS title,
           trim(regexp_replace(regexp_extract_all(html, '(?is)<li\b[^>]*>.*?</li\s*>')[2], '(?s)<[^>]*>', '', 'g')) AS second_item
    FROM pages
""")
def q_html_cell(spark, table):
    html = F.col("html")
    return table("pages").select(
        "page_id",
        nth_element(html, "li", 0).isNotNull().alias("has_item"),
        element_text(nth_element(html, "title", 0)).alias("title"),
        element_text(nth_element(html, "li", 1)).alias("second_item"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS announced,
           CASE o_orderstatus WHEN 'O' THEN 'expected at least 5 tables, found 4'
                WHEN 'P' THEN 'not a date: ' || o_orderpriority END AS problem
    FROM orders
""")
def q_announced_date(spark, table):
    """A page per order: one in three lacks the table, one in three has no date in it."""
    status = F.col("o_orderstatus")
    shown = F.when(status == "F", F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise(F.col("o_orderpriority"))
    fifth = F.concat(F.lit("<table class='x'><tr><th>h</th></tr>\n<tr><td><b> "), shown, F.lit("</b> </td><td>2</td></tr></table>"))
    html = F.concat(F.lit("<html>" + "<table><tr></tr></table>" * 4), F.when(status != "O", fifth).otherwise(F.lit("")), F.lit("</html>"))
    found = pages.announced_date(spread(table("orders")).select("o_orderkey", html.alias("html")))
    return found.select("o_orderkey", "announced", "problem")


@query("""
    SELECT o_orderkey, 'outer ' || o_orderkey || ' tail' AS outer_cell, CAST(o_orderkey AS VARCHAR) AS inner_cell,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS third_cell, CAST(CASE o_orderstatus WHEN 'F' THEN 3 ELSE 2 END AS INTEGER) AS n_tables
    FROM orders
""")
def q_html_table(spark, table):
    """A page per order with a table inside a table, one in a comment, a closing tag too many, and for some a third table that is never closed."""
    third = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("<TABLE CLASS='c'><tr><td>\n"), "o_orderpriority", F.lit(" </td>"))).otherwise(F.lit("</table>"))
    html = F.concat(
        F.lit("<html><!-- <table> --><table id='a'><tr><td>outer <table><tr><td>"), "o_orderkey",
        F.lit("</td></tr></table > tail</td><td>2</td></tr></TABLE>"), third, F.lit("</html>"),
    )
    # Cut once, as a column of its own, for all cells and the count.
    rows = spread(table("orders")).select("o_orderkey", html_segments(html, "table").alias("tables"))
    cells = {name: pages.segments_cell(F.col("tables"), n, 0) for n, name in enumerate(("outer_cell", "inner_cell", "third_cell"))}
    return rows.select("o_orderkey", *[c.alias(n) for n, c in cells.items()], count_opened(F.col("tables")).alias("n_tables"))


XSD = (
    '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">'
    + "".join(
        f'<xs:simpleType name="{name}"><xs:restriction base="xs:string"><xs:enumeration value="{code}"><xs:annotation>'
        f"<xs:documentation>{label}</xs:documentation></xs:annotation></xs:enumeration></xs:restriction></xs:simpleType>"
        for name, code, label in [
            (BULK_CODELISTS["UNIT"], "BUILDING", "Built"),
            (BULK_CODELISTS["FREQ"], "A", "Annual"),
            (BULK_CODELISTS["SCALE"], "1", "Units"),
        ]
    )
    + "</xs:schema>"
)


ARCHIVES_AT_ONCE = 256


def zip_customers(table):
    """A release archive per customer. Segment decides which are broken and how."""

    def pack(batches):
        # Some hundred archives leave a task at a time: a batch has ten thousand rows, whose archives would all be held at once.
        for batch in (batch.iloc[at : at + ARCHIVES_AT_ONCE] for batch in batches for at in range(0, len(batch), ARCHIVES_AT_ONCE)):
            rows = []
            for path, segment, xml in zip(batch["path"], batch["segment"], batch["xml"]):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as folder:
                    folder.writestr("data.xml", f"<D><Header/><DataSet>{xml}</DataSet></D>")
                    folder.writestr("schema.xsd", XSD)
                    if segment == "FURNITURE":
                        folder.writestr("second.xsd", XSD)
                content = out.getvalue()
                if segment == "MACHINERY":
                    content = content.replace(b"<Header/>", b"<Header >", 1)
                rows.append((path, segment, content if segment != "HOUSEHOLD" else b"gone"))
            yield pd.DataFrame(rows, columns=["path", "segment", "content"])

    year = F.lit(2021) + F.col("c_nationkey") % 2
    path = F.concat(F.lit("/"), year, F.lit("/"), "c_custkey", F.lit("/weoapr"), year, F.lit("-sdmxdata.zip"))
    xml = series_text(F.concat(F.lit("C"), "c_custkey"), F.format_number("c_acctbal", 2), F.lit("--"), F.col("c_mktsegment"))
    source = table("customer").select(path.alias("path"), F.col("c_mktsegment").alias("segment"), xml.alias("xml"))
    return spread(source).mapInPandas(pack, "path string, segment string, content binary")


@query("""
    SELECT '/' || (2021 + c_nationkey % 2) || '/' || c_custkey || '/weoapr' || (2021 + c_nationkey % 2) || '-sdmxdata.zip' AS path,
           c_mktsegment <> 'HOUSEHOLD' AS is_zip, CASE c_mktsegment WHEN 'MACHINERY' THEN 'data.xml' END AS bad_member,
           CAST(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 ELSE 1 END AS INTEGER) AS n_xml,
           CAST(CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'FURNITURE' THEN 2 ELSE 1 END AS INTEGER) AS n_xsd,
           CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'not a zip' WHEN 'MACHINERY' THEN 'bad member'
                WHEN 'FURNITURE' THEN 'unexpected members' ELSE 'ok' END AS verdict,
           c_nationkey % 2 <> 0 AS is_retryable
    FROM customer
""")
def q_archive_audit(spark, table):
    report = archives.with_verdict(archives.audit_archives(zip_customers(table).select("path", "content")))
    return report.drop("month", "year")


@query("""
    WITH archives AS (SELECT *, '/' || (2021 + c_nationkey % 2) || '/' || c_custkey || '/weoapr' || (2021 + c_nationkey % 2) || '-sdmxdata.zip' AS path FROM customer)
    SELECT path, 'ok' AS verdict, 'C' || c_custkey AS "CONCEPT_CODE", c_mktsegment AS "UNIT_CODE",
           CASE c_mktsegment WHEN 'BUILDING' THEN 'Built' END AS "UNIT_LABEL", 'Annual' AS "FREQ_LABEL",
           CAST(111 AS INTEGER) AS "REF_AREA_CODE", CAST(NULL AS VARCHAR) AS "REF_AREA_LABEL", CAST(1 AS BIGINT) AS "SCALE_CODE",
           'Units' AS "SCALE_LABEL", CAST(p AS INTEGER) AS "TIME_PERIOD", CASE WHEN p = 1 THEN c_acctbal END AS "OBS_VALUE", '' AS "NOTES"
    FROM archives, (VALUES (1), (2)) AS periods(p) WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')
    UNION ALL SELECT path, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'not a zip' WHEN 'MACHINERY' THEN 'bad member' ELSE 'unexpected members' END,
           NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM archives WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE')
""")
def q_bulk_archives(spark, table):
    """All archives in one pass: observations of the sound ones, and the others with the reason they are refused."""
    rows, report = parse_with_report(zip_customers(table).select("path", "content"))
    columns = [
        "CONCEPT_CODE", "UNIT_CODE", "UNIT_LABEL", "FREQ_LABEL", "REF_AREA_CODE", "REF_AREA_LABEL",
        "SCALE_CODE", "SCALE_LABEL", "TIME_PERIOD", "OBS_VALUE", "NOTES",
    ]
    refused = report.filter("verdict <> 'ok'").select("path", "verdict")
    return rows.select("path", F.lit("ok").alias("verdict"), *columns).unionByName(refused, allowMissingColumns=True)
