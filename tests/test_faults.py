"""Broken or repeated input is an error or is told apart; nothing is lost or doubled without a word."""

import json

import pytest
from conftest import rows, write
from pyspark.sql import functions as F

from macroloom.operators import lookup
from macroloom.plans.vocabulary import extend_unit_map
from macroloom.sources import csvs, json_docs, snapshots, xml_docs
from macroloom.streaming.ingest import ingest_stream, landed_stream, read_ingested


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    write(tmp_path / "c" / "a.csv", "COUNTRY,INDICATOR,OBS_VALUE\nUSA,NGDP,1\n")
    write(tmp_path / "c" / "b c.csv", 'INDICATOR,COUNTRY,NOTE\nNGDP,DEU,"x\ny"\nPCPI,FRA\n')
    got = csvs.read_text_csv(spark, str(tmp_path / "c"))
    assert rows(got, "COUNTRY", "INDICATOR", "OBS_VALUE", "NOTE") == [
        ("DEU", "NGDP", None, "x\ny"), ("FRA", "PCPI", None, None), ("USA", "NGDP", "1", None)
    ]


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_row_of_too_many_cells(spark, tmp_path, multi_line):
    path = write(tmp_path / "a.csv", "A,B\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more than 2 cells in a row"):
        csvs.read_text_csv(spark, path, multi_line).select("A").collect()


def test_broken_json_documents(spark, tmp_path):
    whole = json.dumps({"data": {"codelists": [{"codes": [{"id": "X", "name": "x"}]}]}})
    write(tmp_path / "j" / "IMF" / "CL_A.json", whole)
    assert rows(json_docs.scan_codelists(spark, str(tmp_path / "j"))) == [("IMF", "CL_A", "X", "x")]
    write(tmp_path / "j" / "IMF" / "CL_B.json", whole[:-9])
    with pytest.raises(Exception, match="(?i)malformed"):
        json_docs.scan_codelists(spark, str(tmp_path / "j")).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        json_docs.scan_catalogue(spark, write(tmp_path / "cat.json", '{"data": {"dataflows": [{"id": "WEO"')).collect()


def test_broken_series(spark, tmp_path):
    good = '<Series CONCEPT="A"><Obs TIME_PERIOD="1" OBS_VALUE="2"/></Series>'
    assert xml_docs.scan_series(spark, write(tmp_path / "g.xml", f"<D>{good}</D>")).count() == 1
    bad = write(tmp_path / "b.xml", f'<D>{good}<Series CONCEPT="B"><Obs TIME_PERIOD="1></Series></D>')
    with pytest.raises(Exception, match="(?i)malformed"):
        xml_docs.scan_series(spark, bad).collect()


def test_every_unmapped_key_is_counted_and_written(spark):
    df = spark.createDataFrame([(i,) for i in range(333)], "area int")
    dim = spark.createDataFrame([(0, "A")], "legacy int, code string")
    with pytest.raises(ValueError, match="332 in all") as error:
        lookup.require_mapped(df, dim, {"area": "legacy"}, "areas")
    assert spark.read.parquet(str(error.value).rsplit(", in ", 1)[-1].split(" in ")[-1].rstrip(")")).count() == 332


@pytest.mark.parametrize("check", [True, False])
def test_strict_lookup_refuses_repeated_keys(spark, check):
    df = spark.createDataFrame([(1,)], "area int")
    dim = spark.createDataFrame([(1, "A"), (1, None)], "legacy int, code string")
    with pytest.raises(Exception, match="Repeated keys"):
        lookup.strict_lookup(df, dim, {"area": "legacy"}, {"code": "area"}, "areas", check).collect()


def test_unit_map_has_one_row_per_pair(spark):
    releases = spark.createDataFrame(
        [("X", "K", "Percent", 1.0, "April", 2024), ("Y", "K", None, 1.0, "April", 2024)],
        "CONCEPT_CODE string, UNIT_CODE string, UNIT_LABEL string, OBS_VALUE double, release_month string, release_year int",
    )
    matched = spark.createDataFrame([], "concept string, letter string, unit string")
    decided = spark.createDataFrame([("X", "K", None), ("Y", "K", None), ("Z", "K", None)], "concept string, letter string, unit string")
    got = extend_unit_map(releases, matched, decided)
    assert rows(got, "concept", "letter", "unit") == [("X", "K", "PT"), ("Y", "K", None), ("Z", "K", None)]
    assert lookup.repeated_keys(got, ["concept", "letter"]).count() == 0


def test_snapshots_of_other_versions_are_no_hits(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "OBS_VALUE double")
    for version, schema in (("9.1", "1"), ("9.10", "1"), ("9.1", "2")):
        part = snapshots.keyed(df, sublayer="weo_api", release=("April", 2024), flow_id="WEO", flow_version=version, schema_version=schema)
        snapshots.write_snapshot(part, str(tmp_path / "s"))
    got = snapshots.read_snapshot(spark, str(tmp_path / "s"), flow_version="9.1", schema_version="1")
    assert got.count() == 1 and dict(got.dtypes)["flow_version"] == "string"


def test_restated_and_late_files_of_one_release(spark, tmp_path):
    landing, store, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "k int, release string, v double"
    for n, landed in enumerate([[(1, "a", 1.0), (2, "a", 2.0)], [(1, "a", 1.1)], [(3, "a", 3.0), (None, "a", 4.0)]]):
        spark.createDataFrame(landed, schema).coalesce(1).write.mode("append").parquet(landing)
        ingest_stream(landed_stream(spark, landing, schema, "parquet"), lambda b: b, store, checkpoint, ["release"]).awaitTermination()
        assert spark.read.parquet(store).agg(F.max("batch")).first()[0] == n
    assert rows(read_ingested(spark, store, ["k", "release"]), "k", "v") == [(1, 1.1), (2, 2.0), (3, 3.0), (None, 4.0)]
