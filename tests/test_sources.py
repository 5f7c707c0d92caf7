import datetime as dt
import io
import zipfile

import pytest
from conftest import rows, write
from pyspark.sql import functions as F

from macroloom.errors import BulkPayloadCorruptError, UnexpectedFileError
from macroloom import work
from macroloom.sources import archives, csvs, json_docs, pages, snapshots, text_lines, xml_docs

XML = """<?xml version="1.0" encoding="utf-8"?>
<StructureSpecificData><Header/><DataSet>
  <Series UNIT="B" CONCEPT="NGDP_D" REF_AREA="111" FREQ="A" LASTACTUALDATE="2023" SCALE="1" NOTES=" See &lt;notes&gt;">
    <Obs TIME_PERIOD="1980" OBS_VALUE="39.372"/><Obs TIME_PERIOD="1981" OBS_VALUE="--"/>
  </Series>
  <Series UNIT="E" CONCEPT="NGDP" REF_AREA="111" FREQ="A" SCALE="1" NOTES=""/>
  <Series UNIT="E" CONCEPT="NGDP" REF_AREA="111" FREQ="A" SCALE="1" NOTES=""><Obs TIME_PERIOD="2024" OBS_VALUE="100.5"/></Series>
</DataSet></StructureSpecificData>
"""


def simple_type(name, code, label):
    return (
        f'<xs:simpleType name="{name}"><xs:restriction base="xs:string"><xs:enumeration value="{code}">'
        f'<xs:annotation><xs:documentation xml:lang="en">{label}</xs:documentation></xs:annotation>'
        "</xs:enumeration></xs:restriction></xs:simpleType>"
    )


XSD = (
    '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">'
    + simple_type("IMF.CL_WEO_UNIT.1.0", "B", "Index")
    + simple_type("IMF.CL_WEO_CONCEPT.1.0", "NGDP_D", "Deflator")
    + simple_type("IMF.CL_WEO_REF_AREA.1.0", "111", "United States")
    + simple_type("IMF.CL_FREQ.1.0", "A", "Annual")
    + simple_type("IMF.CL_WEO_SCALE.1.0", "1", "Units")
    + "</xs:schema>"
)


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, text in members:
            z.writestr(name, text)
    return out.getvalue()


def test_observation_scan_nulls_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'COUNTRY,OBS_VALUE,NOTE\nUSA,1.5,"a ""b"" c"\nBEL,n/a,NA\nDEU,,"two\nlines"\n')
    assert [r.multi_line for r in csvs.file_forms(spark, path)] == [True]
    assert rows(csvs.scan_observations(spark, path)) == [
        ("BEL", None, None), ("DEU", None, "two\nlines"), ("USA", "1.5", 'a "b" c'),
    ]


def test_single_line_file_stays_splittable(spark, tmp_path):
    forms = csvs.file_forms(spark, write(tmp_path / "o.csv", 'A,B\n1,"x ""y"""\n'))
    assert [(r.header, r.multi_line) for r in forms] == [("A,B", False)]


def test_sidecar_envelope_and_headers(spark, tmp_path):
    path = write(
        tmp_path / "m.csv",
        "STRUCTURE[;],STRUCTURE_ID,ACTION,TIME_PERIOD,OBS_VALUE,COUNTRY,INDICATOR,FREQUENCY,TOPIC[],KEYWORDS[],SOME_FUTURE\n"
        "dataflow,WEO,I,2024,1.5,USA,NGDP_RPCH,A,F32;F32_CA,growth;GDP,1990\n",
    )
    got = csvs.scan_sidecar(spark, path)
    assert got.columns == ["COUNTRY", "INDICATOR", "FREQUENCY", "TOPIC", "KEYWORDS", "SOME_FUTURE"]
    assert rows(got) == [("USA", "NGDP_RPCH", "A", "F32;F32_CA", "growth;GDP", "1990")]


def test_sidecar_header_collision(spark, tmp_path):
    with pytest.raises(ValueError, match="TOPIC"):
        csvs.scan_sidecar(spark, write(tmp_path / "m.csv", "COUNTRY,TOPIC,TOPIC[]\nUSA,a,b\n"))


def test_sidecar_keeps_not_applicable(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'COUNTRY,NOTES,BASIS\nUSA,A real note,n/a\nBEL,N/A,text\nDEU,,""\n')
    assert rows(csvs.scan_sidecar(spark, path)) == [
        ("BEL", "N/A", "text"), ("DEU", None, None), ("USA", "A real note", "n/a"),
    ]


def test_probes(spark, tmp_path):
    write(tmp_path / "p/WEO/9.0.0.csv", "COUNTRY,INDICATOR,PUBLICATION_DATE\nUSA,NGDP_RPCH,2026-04-14T13:00:00Z\n")
    write(tmp_path / "p/WEO_2025_OCT_VINTAGE/1.0.0.csv", 'PUBLICATION_DATE,NOTE\n2025-10-14,"a, ""b"""\n')
    write(tmp_path / "p/WEO_2024_OCT_VINTAGE/1.0.0.csv", "COUNTRY,PUBLICATION_DATE\n")
    write(tmp_path / "p/WEO_2024_APR_VINTAGE/1.0.0.csv", "COUNTRY\nUSA\n")
    assert rows(csvs.scan_probes(spark, str(tmp_path / "p"))) == [
        ("WEO", "9.0.0", dt.date(2026, 4, 14)),
        ("WEO_2025_OCT_VINTAGE", "1.0.0", dt.date(2025, 10, 14)),
    ]


def test_codelists(spark, tmp_path):
    write(
        tmp_path / "c/IMF/CL_UNIT.json",
        '{"data":{"codelists":[{"codes":[{"id":"OLD","name":"old"}]},{"codes":['
        '{"id":"PT","name":"Percent"},{"id":"IX","names":{"en":"Index"}},{"id":"ZZ"},'
        '{"name":"no id"},{"id":"PT","name":"Percentage"}]}]}}',
    )
    write(tmp_path / "c/IMF.RES/CL_EMPTY.json", '{"data":{"codelists":[]}}')
    assert rows(json_docs.scan_codelists(spark, str(tmp_path / "c"))) == [
        ("IMF", "CL_UNIT", "IX", "Index"), ("IMF", "CL_UNIT", "PT", "Percentage"), ("IMF", "CL_UNIT", "ZZ", ""),
    ]


def test_catalogue(spark, tmp_path):
    path = write(tmp_path / "c.json", '{"data":{"dataflows":[{"id":"WEO","version":"9.0.0"},{"id":"FSI","version":"1"}]}}')
    assert rows(json_docs.scan_catalogue(spark, path)) == [(0, "WEO", "9.0.0"), (1, "FSI", "1")]


def test_xml_scan(spark, tmp_path):
    got = xml_docs.scan_series(spark, write(tmp_path / "d.xml", XML))
    assert rows(got, "CONCEPT", "NOTES", "LASTACTUALDATE", "TIME_PERIOD", "OBS_VALUE") == [
        ("NGDP", "", None, "2024", "100.5"),
        ("NGDP_D", " See <notes>", "2023", "1980", "39.372"),
        ("NGDP_D", " See <notes>", "2023", "1981", "--"),
    ]


def test_obs_attribute_wins(spark):
    df = spark.sql("select 'A' as FREQ, 'series' as NOTE, array(named_struct('TIME_PERIOD','1','NOTE','obs')) as Obs")
    got = xml_docs.series_to_rows(df, obs_attributes=("TIME_PERIOD", "NOTE"))
    assert [r.asDict() for r in got.collect()] == [{"FREQ": "A", "TIME_PERIOD": "1", "NOTE": "obs"}]


def test_xsd_scan(spark, tmp_path):
    got = rows(xml_docs.scan_schema_codes(spark, write(tmp_path / "d.xsd", XSD)))
    assert ("IMF.CL_WEO_UNIT.1.0", "B", "Index") in got and len(got) == 5


def frame_of(spark, contents):
    return spark.createDataFrame([(p, bytearray(c)) for p, c in contents.items()], "path string, content binary")


def test_archive_audit(spark):
    good = zipped(("d.xml", XML), ("d.xsd", XSD))
    bad = good.replace(b"39.372", b"39.373")
    contents = {
        "/2020/weooct2020-sdmxdata.zip": good,
        "/2021/weoapr2021-sdmxdata.zip": bad,
        "/2019/weoapr2019-sdmxdata.zip": b"not a zip",
        "/2019/weooct2019-sdmxdata.zip": zipped(("a.xml", XML), ("b.xml", XML), ("d.xsd", XSD)),
    }
    report = archives.with_verdict(archives.audit_archives(frame_of(spark, contents)))
    got = {r["path"]: (r["verdict"], r["bad_member"], r["is_retryable"]) for r in report.collect()}
    assert got == {
        "/2020/weooct2020-sdmxdata.zip": ("ok", None, True),
        "/2021/weoapr2021-sdmxdata.zip": ("bad member", "d.xml", False),
        "/2019/weoapr2019-sdmxdata.zip": ("not a zip", None, True),
        "/2019/weooct2019-sdmxdata.zip": ("unexpected members", None, True),
    }
    with pytest.raises(BulkPayloadCorruptError, match="itself") as caught:
        archives.require_sound(report.filter("year = 2021"))
    assert not caught.value.is_retryable
    with pytest.raises(UnexpectedFileError):
        archives.require_sound(report.filter("verdict = 'unexpected members'"))
    archives.require_sound(report.filter("verdict = 'ok'"))


def test_elements_do_not_depend_on_piece_size(monkeypatch):
    whole = list(archives._elements(io.BytesIO(XML.encode()), "Series"))
    assert len(whole) == 3
    for size in (1, 7, 64):
        monkeypatch.setattr(archives, "PIECE", size)
        assert list(archives._elements(io.BytesIO(XML.encode()), "Series")) == whole


def test_lines_keep_order_across_blocks(spark, tmp_path):
    text = "\r\n".join(f"line {i}" if i % 7 else "  " for i in range(2000))
    write(tmp_path / "t/a.tsv", text)
    write(tmp_path / "t/b.tsv", "x\n\ny\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = text_lines.scan_lines(spark, str(tmp_path / "t"), "*.tsv")
        assert got.rdd.getNumPartitions() >= 1
        a = [r["value"] for r in got.filter(F.col("file").endswith("a.tsv")).orderBy("line_no").collect()]
        numbers = [r["line_no"] for r in got.filter(F.col("file").endswith("a.tsv")).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert a == [f"line {i}" for i in range(2000) if i % 7]
    assert numbers == list(range(len(a)))
    assert rows(got.filter(F.col("file").endswith("b.tsv")), "line_no", "value") == [(0, "x"), (1, "y")]


def test_announced_date(spark):
    row = "<tr></tr><TR class='x'><td> <b>November 30, 2023</b>\n</td></TR>"
    page = "<table></table>" * 4 + f"<table>{row}</table>"
    cases = {
        "ok": page,
        "few": "<table></table>",
        "rows": "<table></table>" * 4 + "<table><tr></tr></table>",
        "cell": "<table></table>" * 4 + "<table><tr></tr><tr></tr></table>",
        "text": page.replace("November 30, 2023", "soon"),
    }
    df = spark.createDataFrame(list(cases.items()), "name string, html string")
    got = {r["name"]: (r["announced"], r["problem"]) for r in pages.announced_date(df).collect()}
    assert got["ok"] == (dt.date(2023, 11, 30), None)
    assert got["few"][1] == "expected at least 5 tables, found 1"
    assert got["rows"][1] == "expected at least 2 rows, found 1"
    assert got["cell"][1] == "the row has no cell"
    assert got["text"][1] == "not a date: soon"


def test_snapshots(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([("USA", 1.0), ("BEL", 2.0)], "area string, value double")
    april, october = ("April", 2026), ("October", 2025)
    put = lambda d, **k: snapshots.write_snapshot(snapshots.keyed(d, **k), store, sort_by=["area"])
    put(df, sublayer="weo_api", release=april, flow_id="WEO", flow_version="9.0.0")
    put(df, sublayer="weo_api", release=october, flow_id="WEO", flow_version="8.0.0")
    put(df.limit(1), sublayer="sdr", release=april)
    get = lambda **k: snapshots.read_snapshot(spark, store, **k)
    assert get(sublayer="weo_api", release_year=2026).count() == 2
    # The same release under another flow is another snapshot.
    assert get(flow_version="9.1.0").count() == 0
    put(df.limit(1), sublayer="weo_api", release=april, flow_id="WEO", flow_version="9.0.0")
    assert get(sublayer="weo_api", release_year=2026).count() == 1
    assert get(sublayer="weo_api", release_year=2025).count() == 2
    snapshots.clear_snapshots(spark, store, "weo")
    assert rows(get(), "sublayer") == [("sdr",)]
    snapshots.clear_snapshots(spark, store)
    snapshots.clear_snapshots(spark, store)
    with pytest.raises(ValueError):
        snapshots.clear_snapshots(spark, store, "http")


def test_fresh(spark):
    now = dt.datetime(2026, 1, 8, 12)
    stamps = [now - dt.timedelta(seconds=s) for s in (0, 3599, 3600, -50)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, ingested_at timestamp_ntz")
    assert rows(snapshots.fresh(df, snapshots.HOUR, F.lit(now).cast("timestamp_ntz")), "i") == [(0,), (1,), (3,)]


def test_landed_of_a_missing_folder(spark, tmp_path):
    assert work.landed(spark, str(tmp_path / "none")).isEmpty()


def test_landed_lines_keep_their_order(spark, tmp_path):
    from macroloom.showcase import QUERIES

    keys = spark.range(20_000).select(F.col("id").alias("o_orderkey"), F.element_at(F.array(*map(F.lit, "OFP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"))
    keys.repartition(8).write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["q_lines_scan"](spark, str(tmp_path))
    assert found.count() == 20_000 and found.where("line_no <> o_orderkey div 3").isEmpty()


def test_probes_of_many_flows_in_one_file(spark, tmp_path):
    write(tmp_path / "p/WEO/9.0.0.csv", "COUNTRY,PUBLICATION_DATE\nUSA,2026-04-14\nBEL,2025-04-14\n")
    many = 'FLOW_ID,COUNTRY,VERSION,PUBLICATION_DATE\nA,USA,1.0,2025-10-14\n"B, ""b""",USA,2.0,"April 3, 2024"\nA,USA,1.0,2001-01-01\nA,USA,2.0,soon\nC,USA\n'
    write(tmp_path / "p/many.csv", many)
    write(tmp_path / "p/more/others.csv", "PUBLICATION_DATE,VERSION,FLOW_ID\n2023-10-14,3.0,A\n")
    write(tmp_path / "p/more/undated.csv", "VERSION,FLOW_ID\n4.0,A\n")
    assert rows(csvs.scan_probes(spark, str(tmp_path / "p"))) == [
        ("A", "1.0", dt.date(2025, 10, 14)),
        ("A", "3.0", dt.date(2023, 10, 14)),
        ('B, "b"', "2.0", dt.date(2024, 4, 3)),
        ("WEO", "9.0.0", dt.date(2026, 4, 14)),
    ]


def test_landed_probes_do_not_grow_in_files(spark, tmp_path):
    from macroloom.showcase import serving

    suppliers = spark.range(3000).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).alias("s_nationkey"))
    serving.land_probes(lambda name: suppliers.coalesce(1), str(tmp_path))
    assert len(list(tmp_path.rglob("*.csv"))) == 1
    assert csvs.scan_probes(spark, f"{tmp_path}/probes").count() == 1500
