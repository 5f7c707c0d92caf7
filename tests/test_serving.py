"""Pinned release tables, the stream store, archives in one pass, best overlaps."""

import json
import random

import pytest
from conftest import rows, write
from pyspark.sql import functions as F
from test_operators import random_case
from test_sources import XML, XSD, frame_of, zipped

from macroloom.errors import DataflowDiscoveryError
from macroloom.functions.dates import published_date
from macroloom.functions.text import nested_element
from macroloom.showcase.registry import QUERIES
from macroloom.operators import checks, codemap
from macroloom.operators.checks import staged
from macroloom.operators.lookup import lookup, strict_lookup
from macroloom.plans import bulk, outlook, reserves
from macroloom.plans.outlook import FlowRef
from macroloom.sources import archives, bucketed, csvs, manifest, snapshots
from macroloom.streaming import ingest

# -- pinned release table


def land_flows(root, flows, day="2026-04-14"):
    listed = [{"id": i, "version": v} for i, v in flows]
    write(root / "catalogue/flows.json", json.dumps({"data": {"dataflows": listed}}))
    for flow, version in flows:
        write(root / f"probes/{flow}/{version}.csv", f"COUNTRY,PUBLICATION_DATE\nUSA,{day}\n")


def jobs_of(spark, name, call):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = call()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_manifest_read_per_call(spark, tmp_path, monkeypatch):
    land_flows(tmp_path, [("WEO", "9.0.0")])
    served = outlook.Outlook(spark, str(tmp_path))
    assert served.flow_mapping() == {("April", 2026): FlowRef("WEO", "9.0.0")}
    assert jobs_of(spark, "versions", served.versions) == (served.versions(), 1)
    assert jobs_of(spark, "resolve", served.resolve) == ((("April", 2026), FlowRef("WEO", "9.0.0")), 1)
    reads = []
    real = manifest.newest
    monkeypatch.setattr(manifest, "newest", lambda *args: reads.append(args) or real(*args))
    header = "COUNTRY,INDICATOR,UNIT,FREQUENCY,SCALE,TIME_PERIOD,OBS_VALUE"
    write(tmp_path / "observations/WEO/9.0.0/o.csv", f"{header}\nUSA,NGDP,XDC,A,0,2024,1.5\n")
    write(tmp_path / "metadata/WEO/9.0.0/m.csv", "COUNTRY,INDICATOR,FREQUENCY,TOPIC[]\nUSA,NGDP,A,F3\n")
    for call in (served.fetch_data, served.fetch_data_with_metadata, served.fetch_series_metadata, lambda: served.fetch_stored(f"{tmp_path}/store", ("April", 2026))):
        reads.clear()
        assert call().count() == 1 and len(reads) == 1


def test_a_call_keeps_its_flow_when_the_mapping_moves(spark, tmp_path):
    land_flows(tmp_path, [("WEO", "9.0.0")])
    served = outlook.Outlook(spark, str(tmp_path))
    with served._one_manifest():
        before = served.resolve()
        land_flows(tmp_path, [("WEO", "9.0.0"), ("WEO", "9.10.0")])
        served.refresh_mapping()
        assert served.resolve() == before
    assert served.resolve()[1] == FlowRef("WEO", "9.10.0")


def test_lifetime_of_the_mapping(spark, tmp_path):
    land_flows(tmp_path, [("WEO", "9.0.0")])
    hour, instant = outlook.Outlook(spark, str(tmp_path)), outlook.Outlook(spark, str(tmp_path), mapping_ttl=0.001)
    assert list(hour.flow_mapping()) == [("April", 2026)]
    land_flows(tmp_path, [("WEO", "9.0.0")], "14 October 2026")
    assert list(hour.flow_mapping()) == [("April", 2026)]
    hour.refresh_mapping()
    assert list(hour.flow_mapping()) == [("October", 2026)]
    table = outlook.RELEASE_TABLE
    late = "2999-01-01 00:59:00"
    manifest.publish(spark.createDataFrame([("April", 2030, "WEO", "1", True)], table), f"{tmp_path}/pins", now="2998-12-31 23:59:30")
    assert len(manifest.newest(spark, f"{tmp_path}/pins", table, 3600, now=late)) == 1
    assert manifest.newest(spark, f"{tmp_path}/pins", table, 3569, now=late) is None
    assert manifest.newest(spark, f"{tmp_path}/absent", table, 3600) is None
    assert instant.mapping_ttl < 1


def test_unusable_mapping_is_not_published(spark, tmp_path):
    land_flows(tmp_path, [("WEO_2025_OCT_VINTAGE", "1.0.0")])
    served = outlook.Outlook(spark, str(tmp_path))
    with pytest.raises(DataflowDiscoveryError):
        served.versions()
    land_flows(tmp_path, [("WEO", "9.0.0"), ("WEO_2025_OCT_VINTAGE", "1.0.0")])
    assert served.versions()[0] == ("April", 2026)


def test_published_dates(spark):
    cases = {
        "2026-04-14": "2026-04-14", "2026-04-14T13:00:00Z": "2026-04-14", "4/14/2026": "2026-04-14", "April 14, 2026": "2026-04-14", "14 Apr 2026": "2026-04-14",
        "Apr 14, 2026 9:00": "2026-04-14", "20260414": "2026-04-14", "2026/4/14": "2026-04-14", "2026-04": "2026-04-01", "2026": "2026-01-01", "soon": None, "": None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string").withColumn("d", published_date(F.col("t")).cast("string"))
    assert {r.t: r.d for r in df.collect()} == cases


# -- checks in the job that writes


def test_faults_are_counted_by_the_write(spark, monkeypatch):
    facts = spark.createDataFrame([(1, "A", 1.0), (2, "B", None), (None, "C", 3.0), (3, "D", 4.0)], "area int, k string, v double")
    dim = spark.createDataFrame([(1, "USA"), (3, "DEU"), (3, "GER")], "legacy int, code string")
    on, take = {"area": "legacy"}, {"code": "area"}
    flagged = strict_lookup(facts, dim, on, take, "areas", check="flag")
    with pytest.raises(ValueError, match="no such release") as caught:
        staged(flagged, "test", "no such release")
    for text in ("No mapping for areas: 2", "No mapping for areas: null", "Repeated keys in the mapping for areas: 3", "(3 in all"):
        assert text in str(caught.value)
    jobs = []
    monkeypatch.setattr(checks, "refuse_rows", lambda *args: jobs.append(args))
    sound, counts = staged(strict_lookup(facts.filter("area = 1"), dim.filter("legacy = 1"), on, take, "areas", check="flag"), "test", "never")
    assert jobs == [] and counts == {"rows": 1, "faults": 0, "null area": 0, "null k": 0, "null v": 0} and rows(sound, "area", "k", "v") == [("USA", "A", 1.0)]
    _, counts = staged(facts, "test", "never")
    assert counts == {"rows": 4, "faults": 0, "null area": 1, "null k": 0, "null v": 1}


# -- nested tables


def test_nested_elements(spark):
    cases = [
        ("<table>a<table>b</table>c</table><table>d", ["<table>a<table>b</table>c</table>", "<table>b</table>", "<table>d", None]),
        ("</table><TABLE x='1'>a</TABLE ><!-- <table> --><tablet>", ["<TABLE x='1'>a</table>", None, None, None]),
        ("", [None] * 4),
        (None, [None] * 4),
    ]
    df = spark.createDataFrame([(h,) for h, _ in cases], "h string")
    got = df.select(*[nested_element(F.col("h"), "table", n) for n in range(4)]).collect()
    assert [list(r) for r in got] == [w for _, w in cases]


# -- stream store

KEY = ["k", "area"]


def batches(spark, store, checkpoint, landing, *files):
    """Each file is a batch of (k, area, value, flow_version)."""
    for n, data in enumerate(files):
        spark.createDataFrame(data, "k int, area string, value double, flow_version string").coalesce(1).write.mode("append").parquet(landing)
        stream = ingest.landed_stream(spark, landing, "k int, area string, value double, flow_version string", "parquet")
        ingest.ingest_stream(stream, lambda b: b, store, checkpoint, ["flow_version"], ["k"]).awaitTermination()


FILES = [
    [(1, "a", 1.0, "9.1"), (2, None, 2.0, "9.10"), (3, "c", 3.0, None)],
    [(1, "a", 10.0, "9.1"), (4, "d", 4.0, "9.10")],  # one restated, one late
    [(2, None, 20.0, "9.2")],  # restated into another partition, which leaves 9.10 without it
]
LATER = [(5, "e", 5.0, "9.10"), (4, "d", 40.0, "9.10")]


def stored_rows(spark, store):
    return rows(ingest.read_ingested(spark, store, KEY), "k", "area", "value", "flow_version")


def test_compaction_changes_nothing(spark, tmp_path):
    store, checkpoint, landing = (str(tmp_path / n) for n in ("store", "cp", "land"))
    batches(spark, store, checkpoint, landing, FILES[0])
    first = sorted(FILES[0], key=str)
    assert stored_rows(spark, store) == first
    assert ingest.compact_ingested(spark, store, KEY, ["k"]) and not ingest.compact_ingested(spark, store, KEY)
    assert stored_rows(spark, store) == first
    batches(spark, store, checkpoint, landing, FILES[1], FILES[2])
    want = sorted([(1, "a", 10.0, "9.1"), (2, None, 20.0, "9.2"), (3, "c", 3.0, None), (4, "d", 4.0, "9.10")], key=str)
    assert stored_rows(spark, store) == want
    assert ingest.compact_ingested(spark, store, KEY, ["k"])
    merged = ingest.read_ingested(spark, store, KEY)
    assert rows(merged, "k", "area", "value", "flow_version") == want
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan
    batches(spark, store, checkpoint, landing, LATER)
    want = sorted([*[r for r in want if r[0] != 4], *LATER], key=str)
    assert stored_rows(spark, store) == want
    assert ingest.compact_ingested(spark, store, KEY) and stored_rows(spark, store) == want


def test_compaction_shuffles_only_what_is_restated(spark, tmp_path, monkeypatch):
    store, checkpoint, landing = (str(tmp_path / n) for n in ("store", "cp", "land"))
    written = []

    def write(df, *args, **options):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return snapshots_write(df, *args, **options)

    snapshots_write = ingest.write_snapshot
    batches(spark, store, checkpoint, landing, FILES[0])
    monkeypatch.setattr(ingest, "write_snapshot", write)
    assert ingest.compact_ingested(spark, store, KEY)
    assert "Exchange" not in written[0] and "Window" not in written[0]
    merged = ingest.read_ingested(spark, store, KEY)
    assert rows(merged, "k", "area", "value", "flow_version") == sorted(FILES[0], key=str)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_crash_before_the_marker(spark, tmp_path, monkeypatch):
    store, checkpoint, landing = (str(tmp_path / n) for n in ("store", "cp", "land"))
    batches(spark, store, checkpoint, landing, FILES[0], FILES[1])
    want = stored_rows(spark, store)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "_append_log", crash)
        with pytest.raises(RuntimeError):
            ingest.compact_ingested(spark, store, KEY)
    assert stored_rows(spark, store) == want
    assert ingest.compact_ingested(spark, store, KEY) and stored_rows(spark, store) == want


def test_unfinished_batches_are_not_read(spark, tmp_path):
    store, checkpoint, landing = (str(tmp_path / n) for n in ("store", "cp", "land"))
    batches(spark, store, checkpoint, landing, FILES[0])
    half = spark.createDataFrame([(9, "z", 9.0, "9.1", 1)], "k int, area string, value double, flow_version string, batch bigint")
    ingest.write_snapshot(half, store, ["flow_version", "batch"])
    assert stored_rows(spark, store) == sorted(FILES[0], key=str)


def test_flow_versions_are_told_apart_without_a_log(spark, tmp_path):
    store = str(tmp_path / "store")
    old = spark.createDataFrame([(1, "a", 1.0, "9.1", 0), (2, "b", 2.0, "9.10", 0)], "k int, area string, value double, flow_version string, batch bigint")
    ingest.write_snapshot(old, store, ["flow_version", "batch"])
    assert stored_rows(spark, store) == [(1, "a", 1.0, "9.1"), (2, "b", 2.0, "9.10")]


# -- snapshots of every dataset


def test_feeds_metadata_and_codelists_are_stored(spark, tmp_path):
    from test_plans import EXCHANGE, HOLDINGS, INTEREST, land

    land(tmp_path)
    root, store = str(tmp_path), str(tmp_path / "store")
    served = outlook.Outlook(spark, root)
    meta = served.fetch_stored_metadata(store, ("April", 2026))
    assert rows(meta) == rows(served.fetch_series_metadata()) and len(rows(meta)) == 1
    served.ingest_codelists(store)
    served.ingest(store)
    write(tmp_path / "sdr/exchange/2024.tsv", EXCHANGE)
    write(tmp_path / "sdr/interest/2024.tsv", INTEREST)
    assert reserves.ingest(spark, root, store) == ["exchange_sdr", "exchange_usd", "interest"]
    write(tmp_path / "sdr/holdings/2020-6-30.tsv", HOLDINGS)
    for dataset, want in {
        "exchange_sdr": reserves.fetch_exchange_rates(spark, root),
        "interest": reserves.fetch_interest_rates(spark, root),
        "holdings": reserves.all_allocations_holdings(spark, root),
    }.items():
        got = reserves.fetch_stored(spark, root, store, dataset)
        assert got.columns == want.columns and rows(got) == rows(want)
    snapshots.clear_snapshots(spark, store, "sdr")
    assert snapshots.read_snapshot(spark, store, sublayer="sdr_holdings").isEmpty()
    assert rows(served.fetch_stored_metadata(store, ("April", 2026))) == rows(meta)


def test_bucketed_tables_meet_without_an_exchange(spark, tmp_path):
    facts = spark.createDataFrame([(f"s{i % 50}", i) for i in range(400)], "series string, v int")
    dim = spark.createDataFrame([(f"s{i}", f"note {i}") for i in range(0, 50, 2)], "series string, note string")
    a = bucketed.write_bucketed(facts, str(tmp_path / "facts"), "test_bucketed_facts", ["series"], 8)
    bucketed.write_bucketed(dim, str(tmp_path / "dim"), "test_bucketed_dim", ["series"], 8)
    b = bucketed.open_bucketed(spark, str(tmp_path / "dim"), "test_bucketed_again", ["series"], 8)
    joined = lookup(a, b.hint("merge"), {"series": "series"}, {"note": "note"})
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == sorted(((f"s{i % 50}", i, f"note {i % 50}" if i % 2 == 0 else None) for i in range(400)), key=str)


# -- CSV files with cells that span lines


def test_long_cells_in_files_that_are_split(spark, tmp_path):
    """Files of many blocks, cells that span lines and blocks, quotes and CRLF: the same rows as by reading each file whole."""
    rng = random.Random(31)
    for n in range(3):
        out = ["\ufeffkey,text,note"]
        for i in range(400):
            piece = lambda: rng.choice(["x", "y y", '""', ",", "\n", "\r\n", "é", "", "a" * rng.choice([1, 90])])
            text = "".join(piece() for _ in range(rng.randint(0, 12)))
            quoted = f'"{text}"' if any(c in text for c in '",\n\r') else text
            out.append(f'{n}-{i},{quoted},{rng.choice(["", "plain", chr(34) * 2])}')
        if n == 2:
            out[5] = f'2-5,"{"long line{0}".format(chr(10)) * 900}",end'
        write(tmp_path / f"f{n}.csv", rng.choice(["\n", "\r\n"]).join(out) + "\n")
    whole = csvs.read_text_csv(spark, str(tmp_path), multi_line=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        split = csvs.read_text_csv(spark, str(tmp_path))
        lines = csvs.logical_rows(spark, [str(tmp_path)])
        assert split.columns == whole.columns == ["key", "text", "note"]
        assert lines.filter("first").count() == 3
        assert rows(split) == rows(whole) and split.count() == 1200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


# -- archives


def test_archives_in_one_pass(spark):
    good = zipped(("d.xml", XML), ("d.xsd", XSD))
    contents = {
        "/2020/weooct2020-sdmxdata.zip": good,
        "/2019/weoapr2019-sdmxdata.zip": good.replace(b"39.372", b"39.373"),
        "/2019/weooct2019-sdmxdata.zip": b"not a zip",
        "/2018/weooct2018-sdmxdata.zip": zipped(("a.xml", XML), ("d.xsd", XSD), ("e.xsd", XSD)),
        "/2018/weoapr2018-sdmxdata.zip": zipped(("a.xml", XML.encode("utf-16")), ("d.xsd", XSD)),
        "/2017/weoapr2017-sdmxdata.zip": zipped(),
    }
    observations, report = bulk.parse_with_report(frame_of(spark, contents))
    assert {r.path: (r.verdict, r.bad_member) for r in report.collect()} == {
        "/2020/weooct2020-sdmxdata.zip": ("ok", None),
        "/2019/weoapr2019-sdmxdata.zip": ("bad member", "d.xml"),
        "/2019/weooct2019-sdmxdata.zip": ("not a zip", None),
        "/2018/weooct2018-sdmxdata.zip": ("unexpected members", None),
        "/2018/weoapr2018-sdmxdata.zip": ("bad member", "a.xml"),
        "/2017/weoapr2017-sdmxdata.zip": ("unexpected members", None),
    }
    assert {r.path for r in observations.select("path").distinct().collect()} == {"/2020/weooct2020-sdmxdata.zip"}
    assert observations.count() == bulk.parse_archives(frame_of(spark, {"/a.zip": good})).count() == 3
    once = archives.unpack_archives(frame_of(spark, contents))
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1


# -- best overlaps


def exact_top(left, right, k):
    sets = lambda data: {c: {(f, round(v, 4)) for d, f, v in data if d == c} for c, _, _ in data}
    ls, rs = sets(left), sets(right)
    every = {c: sorted(((len(m & r), code) for code, r in rs.items() if m & r), reverse=True)[:k] for c, m in ls.items()}
    return {c: o for c, o in every.items() if o}


def listed(report):
    top = {}
    for r in report.orderBy("code_left", "rank").collect():
        top.setdefault(r["code_left"], []).append((r["overlap"], r["code_right"]))
    return top


@pytest.mark.parametrize("rare", [0, 1, 3])
def test_candidates_with_widely_held_rows(spark, monkeypatch, rare):
    """Whichever rows count as widely held, the best candidates are the same."""
    real = codemap.top_overlaps
    monkeypatch.setattr(codemap, "top_overlaps", lambda *args: real(*args, rare=rare))
    rng = random.Random(21 + rare)
    schema = "code string, f string, v double"
    for _ in range(2):
        left, right = random_case(rng)
        a, b = (codemap.code_sets(spark.createDataFrame(d, schema), "code", ["f"], "v") for d in (left, right))
        codes = spark.createDataFrame([(c,) for c in {x[0] for x in left}], "code_left string")
        assert listed(codemap.candidates_for(codes, a, b)) == exact_top(left, right, 3)


def test_common_values_do_not_pair_all_codes(spark, monkeypatch):
    """300 codes on each side share twelve values; what is paired stays far below 300 x 300."""
    zeros = [("z", float(-i)) for i in range(12)]
    left = [(f"L{i:03d}", f, v) for i in range(300) for f, v in [*zeros, (f"f{i}", float(i)), (f"g{i}", float(i))]]
    right = [(f"R{i:03d}", f, v) for i in range(300) for f, v in [*zeros[: 12 - i % 3], (f"f{i}", float(i))]]
    tables = {}
    real = codemap.stored

    def stored(df, purpose):
        out = real(df, purpose)
        tables.setdefault(purpose, []).append(out)
        return out

    monkeypatch.setattr(codemap, "stored", stored)
    schema = "code string, f string, v double"
    a, b = (codemap.code_sets(spark.createDataFrame(d, schema), "code", ["f"], "v") for d in (left, right))
    codes = spark.createDataFrame([(f"L{i:03d}",) for i in range(300)], "code_left string")
    got = listed(codemap.candidates_for(codes, a, b))
    paired = sum(t.count() for purpose in ("probed", "passing", "classes") for t in tables[purpose])
    assert paired < 300 * 300 / 20
    want = exact_top(left, right, 3)
    assert got == want


def test_classes_that_meet_by_row_are_not_all_paired(spark, monkeypatch):
    """300 codes on each side hold six to nine of twelve common values, at random: only pairs that can be among the best are kept."""
    rng = random.Random(5)
    draw = lambda side: [(f"{side}{i:03d}", "z", float(-v)) for i in range(300) for v in rng.sample(range(12), rng.randrange(6, 10))]
    left, right = draw("L"), draw("R")
    kept = []
    real = codemap.stored
    monkeypatch.setattr(codemap, "stored", lambda df, purpose: kept.append((purpose, real(df, purpose))) or kept[-1][1])
    a, b = (codemap.code_sets(spark.createDataFrame(d, "code string, f string, v double"), "code", ["f"], "v") for d in (left, right))
    got = listed(codemap.candidates_for(spark.createDataFrame([(f"L{i:03d}",) for i in range(300)], "code_left string"), a, b))
    assert got == exact_top(left, right, 3)
    pairs = [t.count() for purpose, t in kept if purpose == "classes" and "more" in t.columns]
    assert pairs and sum(pairs) < 300 * 300 / 4


def test_archives_leave_a_task_in_pieces():
    import io
    import zipfile

    import pandas as pd

    class Frame:
        def mapInPandas(self, unpack, _):
            return unpack

    def packed(n):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as folder:
            folder.writestr("data.xml", "<D>" + f"<Series a='{n}'>{'x' * 300_000}</Series>" * 3 + "</D>")
        return out.getvalue()

    batch = pd.DataFrame({"path": [f"/{n}" for n in range(20)], "content": [packed(n) for n in range(20)]})
    pieces = list(archives.unpack_archives(Frame())(iter([batch])))
    assert sum(map(len, pieces)) == 20 * 4
    assert max(p["element"].str.len().sum() for p in pieces) < 2 * archives.PIECE


def test_pages_are_cut_once(spark, tmp_path):
    spark.range(9).selectExpr("id AS o_orderkey", "'F' AS o_orderstatus", "'x' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["q_html_table"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?i)^<table") == 1 and plan.count("(?i)^<td") == 3
    assert [tuple(r)[1:] for r in found.where("o_orderkey = 7").collect()] == [("outer 7 tail", "7", "x", 3)]
