import datetime as dt

import pytest
from conftest import rows, write
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_sources import XML, XSD, frame_of, zipped

from macroloom import vocabulary_values
from macroloom.errors import (
    BulkPayloadCorruptError,
    DataflowDiscoveryError,
    NoDataError,
    UnexpectedFileError,
    VersionNotAvailableError,
)
from macroloom.operators.observations import observation_slice
from macroloom.operators.releases import known_bulk
from macroloom.plans import align, bulk, outlook, reserves, reserves_feeds, translate, vocabulary
from macroloom.schema import ALIGNED_COLUMNS, CONTRACT_COLUMNS, OBSERVATION_SCHEMA
from macroloom.sources.text_lines import scan_lines
from macroloom.streaming.ingest import ingest_stream, landed_stream

CODES = [
    ("IMF.RES", "CL_WEO_COUNTRY", "USA", "United States"),
    ("IMF.RES", "CL_WEO_COUNTRY", "BEL", "Belgium"),
    ("IMF.RES", "CL_WEO_INDICATOR", "NGDP", "GDP"),
    ("IMF.RES", "CL_WEO_INDICATOR", "NGDP_RPCH", "GDP growth"),
    ("IMF", "CL_UNIT", "XDC", "Domestic currency"),
    ("IMF", "CL_UNIT", "IX", "Index"),
    ("IMF", "CL_UNIT", "PE", "Persons"),
    ("IMF", "CL_FREQ", "A", "Annual"),
]
AREAS = [(111, "USA"), (124, "BEL"), (1, "G001"), (123, "GX123"), (511, "G511")]


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "codelists": spark.createDataFrame(CODES, "agency string, codelist_id string, code string, label string"),
        "area_map": spark.createDataFrame(AREAS, "legacy int, code string"),
        "unit_map": vocabulary_values.unit_map(spark),
        "legacy_labels": vocabulary_values.bulk_only_labels(spark),
    }


FEED = "COUNTRY string, INDICATOR string, UNIT string, FREQUENCY string, SCALE string, TIME_PERIOD string, OBS_VALUE string"


def test_align(spark, dims):
    feed = spark.createDataFrame(
        [("USA", "NGDP", "XDC", "A", s, "2024", v) for s, v in
         [("9", "447416000000.0"), ("6", "2500000"), ("0", "3.1"), ("3", "5000"), (None, "7"), ("0", None), ("6", "words")]]
        + [("LIE", "NEW", "QQ", "M", "0", "20x4", "1")], FEED)
    got = align.align_observations(feed, dims["codelists"], dims["area_map"])
    assert got.columns == ALIGNED_COLUMNS
    types = {f.name: f.dataType for f in OBSERVATION_SCHEMA}
    assert all(f.dataType == types[f.name] for f in got.schema)
    assert rows(got.filter("REF_AREA_CODE = 'USA'"), "OBS_VALUE", "SCALE_CODE", "SCALE_LABEL") == [
        (2.5, 1000000, "Millions"), (3.1, 1, "Units"), (447.416, 1000000000, "Billions"), (5.0, None, None), (7.0, None, None),
        (None, 1000000, "Millions"),
    ]
    first = got.filter("OBS_VALUE = 3.1").first()
    assert (first["REF_AREA_IMF_CODE"], first["REF_AREA_LABEL"], first["CONCEPT_LABEL"], first["UNIT_LABEL"], first["FREQ_LABEL"], first["TIME_PERIOD"]) == (
        111, "United States", "GDP", "Domestic currency", "Annual", 2024)
    other = got.filter("REF_AREA_CODE = 'LIE'").first()
    assert [other[c] for c in ("REF_AREA_IMF_CODE", "REF_AREA_LABEL", "UNIT_LABEL", "FREQ_LABEL", "TIME_PERIOD")] == [None] * 5
    assert observation_slice(got, "USA", "NGDP", (2020, 2024)).count() == 6
    assert observation_slice(got, "USA", "NGDP", (2025, 2026)).count() == 0


def test_unscaled_text_is_an_error(spark, dims):
    feed = spark.createDataFrame([("USA", "NGDP", "XDC", "A", "0", "2024", "words")], FEED)
    with pytest.raises(PySparkException, match="Not a number: words"):
        align.align_observations(feed, dims["codelists"], dims["area_map"]).collect()


def test_bulk_archives(spark):
    got = bulk.parse_archives(frame_of(spark, {"/2024/a.zip": zipped(("d.xml", XML), ("d.xsd", XSD))}))
    assert set(got.columns) == {
        "UNIT_CODE", "CONCEPT_CODE", "REF_AREA_CODE", "FREQ_CODE", "LASTACTUALDATE", "SCALE_CODE", "NOTES", "TIME_PERIOD", "OBS_VALUE",
        "UNIT_LABEL", "CONCEPT_LABEL", "REF_AREA_LABEL", "FREQ_LABEL", "SCALE_LABEL",
    }
    assert rows(got, "UNIT_CODE", "UNIT_LABEL", "REF_AREA_CODE", "TIME_PERIOD", "OBS_VALUE", "LASTACTUALDATE", "SCALE_CODE", "NOTES") == [
        ("B", "Index", 111, 1980, 39.372, 2023, 1, " See <notes>"),
        ("B", "Index", 111, 1981, None, 2023, 1, " See <notes>"),
        ("E", None, 111, 2024, 100.5, None, 1, ""),
    ]


@pytest.mark.parametrize("members", [("x", "x", "s"), ("s",), ("x", "s", "s"), ("x",)])
def test_archive_members(spark, members):
    files = [(f"{i}.{'xml' if m == 'x' else 'xsd'}", XML if m == "x" else XSD) for i, m in enumerate(members)]
    with pytest.raises(UnexpectedFileError):
        bulk.parse_archives(frame_of(spark, {"/a.zip": zipped(*files)}))


def test_many_archives_use_their_own_labels(spark):
    other = XSD.replace("United States", "USA renamed")
    contents = {"/a.zip": zipped(("d.xml", XML), ("d.xsd", XSD)), "/b.zip": zipped(("d.xml", XML), ("d.xsd", other))}
    got = bulk.parse_archives(frame_of(spark, contents), with_path=True)
    assert set(rows(got.distinct(), "path", "REF_AREA_LABEL")) == {("/a.zip", "United States"), ("/b.zip", "USA renamed")}


LEGACY = (
    "REF_AREA_CODE int, UNIT_CODE string, CONCEPT_CODE string, OBS_VALUE double, FREQ_CODE string, LASTACTUALDATE int, SCALE_CODE bigint,"
    " NOTES string, TIME_PERIOD int, UNIT_LABEL string, CONCEPT_LABEL string, REF_AREA_LABEL string, FREQ_LABEL string, SCALE_LABEL string"
)


def legacy(spark, *items):
    rest = ("A", None, 0, None, 2024, "u", "c", "own label", "Annual", "Units")
    return spark.createDataFrame([(*i, *rest) for i in items], LEGACY)


def test_translation(spark, dims):
    df = legacy(spark, (111, "E", "NGDP", 1.0), (511, "E", "NGDP", 1.0), (123, "C", "LE", 1.0), (1, "N", "LE", 1.0), (111, "O", "PSUGAEEC", 1.0), (111, "E", "NGDP", None))
    got = translate.translate_release(df, **dims)
    assert got.columns == CONTRACT_COLUMNS
    assert got.schema["COUNTRY_UPDATE_DATE"].dataType == OBSERVATION_SCHEMA["COUNTRY_UPDATE_DATE"].dataType
    assert rows(got, "REF_AREA_CODE", "REF_AREA_IMF_CODE", "UNIT_CODE", "REF_AREA_LABEL", "UNIT_LABEL", "CONCEPT_LABEL", "FREQ_LABEL") == [
        ("G001", 1, "PE", None, "Persons", None, "Annual"),
        ("G511", 511, "XDC", "ASEAN-5", "Domestic currency", "GDP", "Annual"),
        ("GX123", 123, "IX", None, "Index", None, "Annual"),
        ("USA", 111, "XDC", "United States", "Domestic currency", "GDP", "Annual"),
        ("USA", 111, None, "United States", None, None, "Annual"),
    ]


@pytest.mark.parametrize("bad", [(999999, "E", "NGDP", 1.0), (None, "E", "NGDP", 1.0), (111, "Z", "NOTREAL", 1.0), (111, None, "NGDP", 1.0)])
@pytest.mark.parametrize("check", [True, False])
def test_translation_is_strict(spark, dims, bad, check):
    df = legacy(spark, (111, "E", "NGDP", 1.0), bad)
    with pytest.raises((ValueError, PySparkException), match="No mapping for"):
        translate.translate_release(df, **dims, check=check).collect()


def test_fixed_vocabulary(spark, dims):
    units = dims["unit_map"]
    assert units.filter("unit is not null").count() == 168
    assert units.filter("unit is null").count() == 5
    assert units.select("concept", "letter").distinct().count() == 173
    assert dims["legacy_labels"].count() == 4


# -- feeds

EXCHANGE = (
    "SDR Valuations\nReport date\tCurrency Unit\tCurrency amount\tExchange Rate\n"
    "2023-11-30\tEuro\t0.456\t-1.234\n2023-11-30\tYen\t1\t2\nU.S.$1.00 = SDR\t0.123\nSDR1 = US$\t0.321\n"
    "2023-12-01\tEuro\t0.456\t-1.234\n2023-12-01\tYen\t1\t2\nU.S.$1.00 = SDR\tn/a\n"
)
INTEREST = (
    "SDR Interest Rate Calculation\nEffective from\tEffective to\tCurrency Unit\tCurrency amount\tExchange rate\n"
    "01/12/2024\t05/12/2024\tN/A\tN/A\nSDR Interest Rate\t1.50\n06/12/2024\t08/12/2024\tN/A\tN/A\nTotal\t2.75\n"
    "09/12/2024\t12/12/2024\tN/A\tN/A\nFloor for SDR Interest Rate\t3.50\nempty row\n"
)
HOLDINGS = (
    "SDR Allocations and Holdings\nfor all members as of June 30, 2020\n(in SDRs)\n\nMembers\tSDR Holdings\tSDR Allocations\n"
    "Spain\t123\t456\nTotal\t-3,21\n"
)
PAGE = "<table></table>" * 4 + "<table><tr></tr><tr><td>June 30, 2020</td></tr></table>"


def test_exchange_feed(spark, tmp_path):
    lines = scan_lines(spark, write(tmp_path / "e.tsv", EXCHANGE))
    assert rows(reserves_feeds.exchange_rates(lines, "USD"), "date", "exchange_rate") == [
        (dt.date(2023, 11, 30), 0.123), (dt.date(2023, 12, 1), None),
    ]
    # One rate line is missing, so the second date stays without a rate.
    assert rows(reserves_feeds.exchange_rates(lines, "SDR"), "ordinal", "date", "exchange_rate") == [
        (0, dt.date(2023, 11, 30), 0.321), (1, dt.date(2023, 12, 1), None),
    ]
    with pytest.raises(ValueError):
        reserves_feeds.exchange_rates(lines, "EUR")
    bad = scan_lines(spark, write(tmp_path / "b.tsv", EXCHANGE.replace("Report date", "Date")))
    with pytest.raises(KeyError, match="Report date"):
        reserves_feeds.exchange_rates(bad)


def test_interest_feed(spark, tmp_path):
    lines = scan_lines(spark, write(tmp_path / "i.tsv", INTEREST))
    assert reserves_feeds.interest_rows(lines).count() == 6
    assert rows(reserves_feeds.interest_rates(lines), "interest_rate", "effective_from", "effective_to") == [
        (1.5, dt.date(2024, 1, 12), dt.date(2024, 5, 12))
    ]
    bad = scan_lines(spark, write(tmp_path / "b.tsv", INTEREST.replace("Effective from", "From")))
    with pytest.raises(KeyError, match="Effective from"):
        reserves_feeds.interest_rates(bad)


def test_reserves_api(spark, tmp_path):
    root = str(tmp_path)
    for call in (reserves.fetch_exchange_rates, reserves.fetch_interest_rates, reserves.fetch_allocations_holdings):
        with pytest.raises(ValueError, match="nothing is landed"):
            call(spark, root)
    write(tmp_path / "sdr/exchange/2024.tsv", EXCHANGE)
    write(tmp_path / "sdr/interest/2024.tsv", INTEREST)
    write(tmp_path / "sdr/holdings/2020-6-30.tsv", HOLDINGS)
    write(tmp_path / "sdr/pages/main.html", PAGE)
    assert rows(reserves.fetch_exchange_rates(spark, root))[0] == (dt.date(2023, 11, 30), 0.321)
    assert reserves.fetch_interest_rates(spark, root).count() == 1
    assert reserves.fetch_latest_allocations_holdings_date(spark, root) == (2020, 6)
    day = dt.date(2020, 6, 30)
    want = [("Spain", "allocations", 456.0, day), ("Spain", "holdings", 123.0, day), ("Total", "allocations", None, day), ("Total", "holdings", 321.0, day)]
    assert rows(reserves.fetch_allocations_holdings(spark, root)) == want
    assert rows(reserves.fetch_allocations_holdings(spark, root, (2020, 6))) == want
    assert rows(reserves.all_allocations_holdings(spark, root)) == want
    with pytest.raises(ValueError, match="Latest available"):
        reserves.fetch_allocations_holdings(spark, root, (2020, 7))
    with pytest.raises(ValueError, match="not available for this date"):
        reserves.fetch_allocations_holdings(spark, root, (2020, 5))


# -- serving releases


def land(root, catalogue=True):
    if catalogue:
        flows = [("WEO", "9.0.0"), ("WEO_2025_OCT_VINTAGE", "1.0.0"), ("WEO_2024_JUL_VINTAGE", "1.0.0"), ("FSI", "1.0")]
        listed = ",".join(f'{{"id":"{i}","version":"{v}"}}' for i, v in flows)
        write(root / "catalogue/flows.json", f'{{"data":{{"dataflows":[{listed}]}}}}')
        write(root / "probes/WEO/9.0.0.csv", "COUNTRY,PUBLICATION_DATE\nUSA,2026-04-14T13:00:00Z\n")
    for agency, codelist in {c[:2] for c in CODES}:
        codes = ",".join(f'{{"id":"{c[2]}","name":"{c[3]}"}}' for c in CODES if c[:2] == (agency, codelist))
        write(root / f"codelists/{agency}/{codelist}.json", f'{{"data":{{"codelists":[{{"codes":[{codes}]}}]}}}}')
    header = "COUNTRY,INDICATOR,UNIT,FREQUENCY,SCALE,TIME_PERIOD,OBS_VALUE"
    write(root / "observations/WEO/9.0.0/o.csv", f"{header}\nUSA,NGDP_RPCH,XDC,A,0,2024,1.5\nBEL,NGDP_RPCH,XDC,A,0,2024,\n")
    write(root / "observations/WEO_2025_OCT_VINTAGE/1.0.0/o.csv", f"{header}\nUSA,NGDP_RPCH,XDC,A,6,2024,2500000\n")
    write(
        root / "metadata/WEO/9.0.0/m.csv",
        "STRUCTURE[;],COUNTRY,INDICATOR,FREQUENCY,LATEST_ACTUAL_ANNUAL_DATA,METHODOLOGY_NOTES,COUNTRY_UPDATE_DATE,TOPIC[]\n"
        "dataflow,USA,NGDP_RPCH,A,2024,a note,9/19/2025,F32;F3\n",
    )
    path = root / "bulk/2025/april/weoapr2025-sdmxdata.zip"
    path.parent.mkdir(parents=True, exist_ok=True)
    xml = XML.replace('OBS_VALUE="--"', 'OBS_VALUE="1,040.5"')
    path.write_bytes(zipped(("weo_data.xml", xml), ("weo_schema.xsd", XSD)))


@pytest.fixture
def served(spark, tmp_path, dims):
    land(tmp_path)
    return outlook.Outlook(spark, str(tmp_path), dims["area_map"])


def test_mapping_and_versions(served):
    mapping = served.flow_mapping()
    assert mapping == {("April", 2026): ("WEO", "9.0.0"), ("October", 2025): ("WEO_2025_OCT_VINTAGE", "1.0.0")}
    versions = served.versions()
    assert versions[:4] == [("April", 2026), ("October", 2025), ("April", 2025), ("October", 2024)]
    assert ("April", 2021) not in versions and len(versions) == 13


def test_fetch_data(served):
    latest = served.serve()
    assert latest.release == ("April", 2026) and latest.ref == ("WEO", "9.0.0")
    assert latest.data.schema == OBSERVATION_SCHEMA or latest.data.columns == CONTRACT_COLUMNS
    assert rows(latest.data, "REF_AREA_CODE", "OBS_VALUE", "LASTACTUALDATE", "NOTES", "COUNTRY_UPDATE_DATE", "REF_AREA_LABEL") == [
        ("USA", 1.5, 2024, "a note", dt.datetime(2025, 9, 19), "United States")
    ]
    # The sidecar of the archival flow is not landed; its columns are null.
    assert rows(served.fetch_data((" october", "2025")), "OBS_VALUE", "NOTES") == [(2.5, None)]


def test_fetch_bulk(served):
    got = served.serve(("April", 2025))
    assert got.ref is None
    assert rows(got.data, "REF_AREA_CODE", "CONCEPT_CODE", "UNIT_CODE", "TIME_PERIOD", "OBS_VALUE") == [
        ("USA", "NGDP", "XDC", 2024, 100.5), ("USA", "NGDP_D", "IX", 1980, 39.372), ("USA", "NGDP_D", "IX", 1981, 1040.5),
    ]
    with pytest.raises(NoDataError):
        served.fetch_data(("October", 2024))
    with pytest.raises(NoDataError):
        served.fetch_data(("March", 2024))
    with pytest.raises(VersionNotAvailableError):
        served.fetch_data_with_metadata(("April", 2025))


def test_corrupt_archive_surfaces(served, tmp_path):
    (tmp_path / "bulk/2025/april/weoapr2025-sdmxdata.zip").write_bytes(b"no zip")
    with pytest.raises(BulkPayloadCorruptError):
        served.fetch_data(("April", 2025))


def test_metadata_api(served):
    meta = served.fetch_series_metadata()
    assert meta.columns == ["REF_AREA_CODE", "CONCEPT_CODE", "FREQ_CODE", "LATEST_ACTUAL_ANNUAL_DATA", "METHODOLOGY_NOTES", "TOPIC"]
    merged = served.fetch_data_with_metadata()
    assert merged.columns == [*CONTRACT_COLUMNS, "LATEST_ACTUAL_ANNUAL_DATA", "METHODOLOGY_NOTES", "TOPIC"]
    assert rows(merged, "OBS_VALUE", "NOTES", "TOPIC") == [(1.5, "a note", "F32;F3")]
    with pytest.raises(VersionNotAvailableError, match="Series metadata"):
        served.fetch_series_metadata(("April", 2025))


def test_failed_probe_of_the_bare_flow_raises(served, tmp_path):
    (tmp_path / "probes/WEO/9.0.0.csv").write_text("COUNTRY\nUSA\n")
    with pytest.raises(ValueError, match="9.0.0"):
        served.flow_mapping()


def test_no_catalogue(spark, tmp_path, dims):
    land(tmp_path, catalogue=False)
    got = outlook.Outlook(spark, str(tmp_path), dims["area_map"])
    with pytest.raises(DataflowDiscoveryError):
        got.serve()
    # An explicit release keeps its label, so the archive may serve it.
    assert got.serve(("April", 2025)).data.count() == 3


def test_roll_back(served, monkeypatch):
    real = served.bulk_release
    tried = []

    def resolve(release=None, purpose="observations"):
        tried.append(release)
        raise VersionNotAvailableError("no flow")

    monkeypatch.setattr(served, "resolve", resolve)
    monkeypatch.setattr(served, "bulk_release", real)
    got = served.serve()
    assert got.release == ("April", 2025)
    assert tried == [("April", 2026), ("October", 2025), ("April", 2025)]
    monkeypatch.setattr(served, "bulk_release", lambda release: (_ for _ in ()).throw(NoDataError(str(release))))
    with pytest.raises(NoDataError, match="April.*2026"):
        served.serve()
    assert len(tried) == 3 + 4
    monkeypatch.setattr(served, "bulk_release", lambda release: (_ for _ in ()).throw(ConnectionError("refused")))
    with pytest.raises(ConnectionError):
        served.serve()


def test_snapshot_of_a_release(spark, served, tmp_path):
    store = str(tmp_path / "store")
    assert served.ingest(store) == ("April", 2026)
    assert served.ingest(store, ("April", 2025)) == ("April", 2025)
    flow = outlook.read_release(spark, store, ("April", 2026), outlook.FlowRef("WEO", "9.0.0"))
    assert flow.columns == CONTRACT_COLUMNS and rows(flow, "OBS_VALUE") == [(1.5,)]
    assert outlook.read_release(spark, store, ("April", 2026), outlook.FlowRef("WEO", "9.1.0")).isEmpty()
    assert outlook.read_release(spark, store, ("April", 2025)).count() == 3


def test_stored_release_is_refreshed(spark, served, tmp_path):
    store = str(tmp_path / "store")
    assert rows(served.fetch_stored(store, ("April", 2026)), "OBS_VALUE") == [(1.5,)]
    csv = tmp_path / "observations/WEO/9.0.0/o.csv"
    csv.write_text(csv.read_text().replace("1.5", "1.75"))
    spark.catalog.clearCache()
    assert rows(served.fetch_stored(store, ("April", 2026)), "OBS_VALUE") == [(1.5,)]
    assert rows(served.fetch_stored(store, ("April", 2026), ttl_seconds=0), "OBS_VALUE") == [(1.75,)]
    assert served.fetch_stored(store, ("April", 2025)).count() == 3


def test_known_bulk(spark):
    assert rows(known_bulk(spark).filter("corrupt"), "month", "year") == [("April", 2021), ("October", 2023)]


def test_build_vocabulary(spark, tmp_path):
    """From landed files only: the area and unit tables come out of the releases themselves."""
    land(tmp_path)
    write(tmp_path / "probes/WEO/9.0.0.csv", "COUNTRY,PUBLICATION_DATE\nUSA,2025-04-22T13:00:00Z\n")
    years = range(1990, 2010)
    xml = "".join(
        f'<Series UNIT="{u}" CONCEPT="{c}" REF_AREA="{a}" FREQ="A" SCALE="1">'
        + "".join(f'<Obs TIME_PERIOD="{y}" OBS_VALUE="{a * 10 + y / 8}"/>' for y in years)
        + "</Series>"
        for a in (111, 124)
        for u, c in (("E", "NGDP"), ("B", "PCPI"))
    )
    header = "COUNTRY,INDICATOR,UNIT,FREQUENCY,SCALE,TIME_PERIOD,OBS_VALUE"
    lines = [
        f"{code},{c},{u},A,0,{y},{a * 10 + y / 8}" for a, code in ((111, "USA"), (124, "BEL")) for c, u in (("NGDP", "XDC"), ("PCPI", "IX")) for y in years
    ]
    write(tmp_path / "observations/WEO/9.0.0/o.csv", "\n".join([header, *lines]))
    archive = zipped(("d.xml", f"<D><Header/><DataSet>{xml}</DataSet></D>"), ("d.xsd", XSD))
    (tmp_path / "bulk/2025/april/weoapr2025-sdmxdata.zip").write_bytes(archive)
    corrupt = tmp_path / "bulk/2021/weoapr2021-sdmxdata.zip"
    corrupt.parent.mkdir(parents=True)
    corrupt.write_bytes(b"known to be corrupt, so not read")
    landing = outlook.Outlook(spark, str(tmp_path))
    tables = landing.build_vocabulary(("April", 2025), bulk_only=(511,))
    assert rows(tables["area_map"]) == [(111, "USA"), (124, "BEL"), (511, "G511")]
    assert ("NGDP", "E", "XDC") in rows(tables["unit_map"]) and ("PCPI", "B", "IX") in rows(tables["unit_map"])
    translated = landing.bulk_release(("April", 2025))
    assert rows(translated.select("REF_AREA_CODE", "UNIT_CODE").distinct()) == [("BEL", "IX"), ("BEL", "XDC"), ("USA", "IX"), ("USA", "XDC")]


# -- vocabulary job

PARSED = LEGACY + ", release_month string, release_year int"


def vocabulary_case(spark):
    names = {111: "USA", 124: "BEL", 1: "G001"}
    anchor, api = [], []
    for area, code in names.items():
        for year in range(2000, 2012):
            for concept, letter, unit in [("NGDP", "E", "XDC"), ("LE", "C", None), ("PCPI", "B", "IX"), ("PPPEX", "F", None)]:
                value = float(area * 10 + year % 100) + (0.5 if concept == "LE" else 0.0)
                label = {"E": "National currency", "C": "Index, 2000=100", "B": "Index", "F": "PPP rate"}[letter]
                anchor.append((area, letter, concept, value, "A", None, 0, None, year, label, "c", f"name {area}", "Annual", "Units", "April", 2025))
                api.append((code, concept, unit, year, value))
    old = [(406, "B", "PCPI", 1.0, "A", None, 0, None, 1999, "Index", "c", "", "Annual", "Units", "April", 2019),
           (406, "B", "PCPI", 1.0, "A", None, 0, None, 1999, "Index", "c", "Region", "Annual", "Units", "October", 2019),
           (111, "H", "OLD", 1.0, "A", None, 0, None, 1999, "Percent change", "c", "USA", "Annual", "Units", "April", 2019),
           (111, "N", "LE", 1.0, "A", None, 0, None, 1999, "Persons", "c", "USA", "Annual", "Units", "April", 2019),
           (111, "N", "GONE", None, "A", None, 0, None, 1999, "?", "c", "USA", "Annual", "Units", "April", 2019)]
    return (
        spark.createDataFrame(anchor + old, PARSED),
        spark.createDataFrame(api, "REF_AREA_CODE string, CONCEPT_CODE string, UNIT_CODE string, TIME_PERIOD int, OBS_VALUE double"),
    )


def test_vocabulary_job(spark, tmp_path):
    releases, api = vocabulary_case(spark)
    tables = vocabulary.derive_vocabulary(releases, api, ("April", 2025), bulk_only=(406,))
    vocabulary.write_vocabulary(tables, str(tmp_path / "v"))
    read = lambda name: rows(spark.read.parquet(str(tmp_path / "v" / name)))
    assert read("area_map") == [(1, "G001"), (111, "USA"), (124, "BEL"), (406, "G406")]
    assert read("area_map_inverse") == [("BEL", 124), ("G001", 1), ("G406", 406), ("USA", 111)]
    assert read("legacy_labels") == [("G406", "Region")]
    units = read("unit_map")
    for entry in [("NGDP", "E", "XDC"), ("PCPI", "B", "IX"), ("LE", "C", "IX"), ("OLD", "H", "PT"), ("LE", "N", "PE"), ("PPPEX", "F", None), ("PSUGAEEC", "O", None)]:
        assert entry in units
    assert len(units) == len({u[:2] for u in units})


def test_vocabulary_aborts(spark):
    releases, api = vocabulary_case(spark)
    with pytest.raises(ValueError, match="Areas without a code.*406"):
        vocabulary.derive_vocabulary(releases, api, ("April", 2025), bulk_only=())
    twin = api.union(api.filter("REF_AREA_CODE = 'BEL'").withColumn("REF_AREA_CODE", F.lit("TWIN")))
    with pytest.raises(ValueError, match="Ambiguous area matches.*TWIN"):
        vocabulary.derive_vocabulary(releases, twin, ("April", 2025), bulk_only=(406,))
    odd = releases.union(releases.filter("CONCEPT_CODE = 'OLD'").withColumn("UNIT_LABEL", F.lit("?")).withColumn("UNIT_CODE", F.lit("Y")))
    with pytest.raises(ValueError, match="Unit pairs nothing explains.*OLD"):
        vocabulary.derive_vocabulary(odd, api, ("April", 2025), bulk_only=(406,))


# -- streaming


def test_stream_ingest(spark, tmp_path, dims):
    write(tmp_path / "land/release=a/o.csv", "COUNTRY,INDICATOR,UNIT,FREQUENCY,SCALE,TIME_PERIOD,OBS_VALUE\nUSA,NGDP,XDC,A,0,2024,1.5\n")
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")

    def run():
        stream = landed_stream(spark, str(tmp_path / "land"), FEED + ", release string", "csv", header="true")
        transform = lambda b: align.align_observations(b, dims["codelists"], dims["area_map"], keep=["release"])
        ingest_stream(stream, transform, store, checkpoint, ["release"], ["CONCEPT_CODE"]).awaitTermination()
        return rows(spark.read.parquet(store), "release", "REF_AREA_CODE", "OBS_VALUE")

    assert run() == [("a", "USA", 1.5)]
    assert run() == [("a", "USA", 1.5)]
    write(tmp_path / "land/release=b/o.csv", "COUNTRY,INDICATOR,UNIT,FREQUENCY,SCALE,TIME_PERIOD,OBS_VALUE\nBEL,NGDP,XDC,A,6,2024,2000000\n")
    assert run() == [("a", "USA", 1.5), ("b", "BEL", 2.0)]
