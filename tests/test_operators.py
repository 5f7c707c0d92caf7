import datetime as dt
import itertools
import random

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from macroloom.operators import codemap, lookup, metadata, observations, positional, profile, reconcile, releases

META = "COUNTRY string, INDICATOR string, FREQUENCY string, LATEST_ACTUAL_ANNUAL_DATA string, METHODOLOGY_NOTES string, COUNTRY_UPDATE_DATE string"
FACT = "REF_AREA_CODE string, CONCEPT_CODE string, FREQ_CODE string, OBS_VALUE double"
USA = ("USA", "NGDP_RPCH", "A", "2024", "a note", "9/19/2025")


def facts(spark, *areas):
    return spark.createDataFrame([(a, "NGDP_RPCH", "A", 1.0) for a in areas], FACT)


def values(df):
    return rows(df, "REF_AREA_CODE", "LASTACTUALDATE", "NOTES", "COUNTRY_UPDATE_DATE")


# -- lookups


def test_lookup_keeps_rows_and_replaces_output(spark):
    df = spark.createDataFrame([("a", "old"), (None, "old"), ("z", "old")], "k string, label string")
    dim = spark.createDataFrame([("a", "A"), (None, "none")], "k string, label string")
    assert rows(lookup.lookup(df, dim, {"k": "k"}, {"label": "label"})) == [("a", "A"), ("z", None), (None, None)]
    assert rows(lookup.lookup(df, dim, {"k": "k"}, {"label": "label"}, null_safe=True)) == [
        ("a", "A"), ("z", None), (None, "none"),
    ]


@pytest.mark.parametrize("check", [True, False])
def test_strict_lookup(spark, check):
    dim = spark.createDataFrame([("LE", "C", "IX"), ("PPPEX", "F", None)], "concept string, letter string, unit string")
    on = {"c": "concept", "l": "letter"}
    good = spark.createDataFrame([("LE", "C"), ("PPPEX", "F")], "c string, l string")
    got = lookup.strict_lookup(good, dim, on, {"unit": "l"}, "pairs", check)
    assert rows(got, "c", "l") == [("LE", "IX"), ("PPPEX", None)]
    for bad in [("NOTREAL", "Z"), (None, "C"), ("LE", None)]:
        df = spark.createDataFrame([("LE", "C"), bad], "c string, l string")
        with pytest.raises((ValueError, PySparkException), match="No mapping for pairs"):
            lookup.strict_lookup(df, dim, on, {"unit": "unit"}, "pairs", check).collect()


def test_inline_check_names_the_key_it_replaces(spark):
    dim = spark.createDataFrame([(1, "A")], "legacy int, code string")
    df = spark.createDataFrame([(1,), (999,)], "area int")
    with pytest.raises(PySparkException, match="areas: 999"):
        lookup.strict_lookup(df, dim, {"area": "legacy"}, {"code": "area"}, "areas", check=False).collect()


def test_label_with_fallback(spark):
    df = spark.createDataFrame([("USA", "x"), ("G511", "x"), ("QQQ", "x")], "c string, label string")
    labels = spark.createDataFrame([("USA", "United States")], "code string, label string")
    fallback = spark.createDataFrame([("G511", "ASEAN-5"), ("USA", "no")], "code string, label string")
    assert rows(lookup.label_with_fallback(df, labels, fallback, "c", "label")) == [
        ("G511", "ASEAN-5"), ("QQQ", None), ("USA", "United States"),
    ]


def test_coded_column_label(spark):
    codes = spark.createDataFrame(
        [("IMF.RES", "CL_TOPIC", "F32", "Growth"), ("IMF.RES", "CL_OTHER", "F32", "no")],
        "agency string, codelist_id string, code string, label string",
    )
    df = spark.createDataFrame([("F32",)], "TOPIC string")
    assert rows(lookup.coded_column_label(df, codes, "TOPIC")) == [("F32", "Growth")]


def test_inverse(spark):
    m = spark.createDataFrame([(1, "A"), (2, "B")], "legacy int, code string")
    inverse = lookup.strict_inverse(m, "legacy", "code")
    assert inverse.columns == ["code", "legacy"]
    assert rows(lookup.strict_inverse(inverse, "code", "legacy")) == rows(m)
    with pytest.raises(ValueError, match="one-to-one"):
        lookup.strict_inverse(m.union(m.select(F.lit(3), F.lit("A"))), "legacy", "code")


# -- metadata join


def test_metadata_match_and_unmatched(spark):
    got = metadata.attach_series_metadata(facts(spark, "USA", "BEL"), spark.createDataFrame([USA], META))
    assert values(got) == [("BEL", None, None, None), ("USA", 2024, "a note", dt.datetime(2025, 9, 19))]


@pytest.mark.parametrize("case", ["absent", "duplicate", "missing column"])
def test_metadata_degrades(spark, case):
    sidecar = spark.createDataFrame([USA, USA[:4] + ("other",) + USA[5:]], META)
    if case == "absent":
        sidecar = None
    elif case == "missing column":
        sidecar = sidecar.limit(1).drop("LATEST_ACTUAL_ANNUAL_DATA")
    got = metadata.attach_series_metadata(facts(spark, "USA"), sidecar)
    assert values(got) == [("USA", None, None, None)]
    assert dict(got.dtypes)["COUNTRY_UPDATE_DATE"] == "timestamp_ntz"
    assert dict(got.dtypes)["LASTACTUALDATE"] == "int"


def test_stale_copies_are_replaced_and_wide_sidecar_does_not_leak(spark):
    stale = facts(spark, "USA").selectExpr("*", "2000 LASTACTUALDATE", "'stale' NOTES", "'1/1/2000' COUNTRY_UPDATE_DATE")
    wide = spark.createDataFrame([USA], META).selectExpr("*", "'F32' TOPIC")
    got = metadata.attach_series_metadata(stale, wide)
    assert got.columns == ["REF_AREA_CODE", "CONCEPT_CODE", "FREQ_CODE", "OBS_VALUE", "LASTACTUALDATE", "NOTES", "COUNTRY_UPDATE_DATE"]
    assert values(got) == [("USA", 2024, "a note", dt.datetime(2025, 9, 19))]


def test_row_count_never_changes(spark):
    rng = random.Random(7)
    keys = ["USA", "BEL", "DEU", None]
    for _ in range(4):
        left = facts(spark, *[rng.choice(keys) for _ in range(30)])
        side = [(rng.choice(keys), "NGDP_RPCH", rng.choice(["A", "Q"]), "2024", "n", None) for _ in range(rng.randint(0, 4))]
        got = metadata.attach_series_metadata(left, spark.createDataFrame(side, META))
        assert got.count() == 30


def test_many_releases_at_once(spark):
    side = spark.createDataFrame(
        [("r1", *USA), ("r2", *USA), ("r2", *USA[:4], "again", None), ("r3", *USA[:4], "third", None)], "release string, " + META
    )
    left = facts(spark, "USA").crossJoin(spark.createDataFrame([("r1",), ("r2",), ("r3",)], "release string"))
    got = metadata.attach_series_metadata(left, side, scope=["release"])
    assert rows(got, "release", "NOTES") == [("r1", "a note"), ("r2", None), ("r3", "third")]


def test_repair(spark):
    sidecar = spark.createDataFrame([USA], META)
    degraded = metadata.attach_series_metadata(facts(spark, "USA", "BEL"), None)
    got = metadata.repair_if_degraded(degraded, sidecar)
    assert got.columns == degraded.columns
    assert rows(got, "REF_AREA_CODE", "NOTES") == [("BEL", None), ("USA", "a note")]
    healthy = metadata.attach_series_metadata(facts(spark, "USA"), spark.createDataFrame([USA[:4] + ("kept", None)], META))
    assert rows(metadata.repair_if_degraded(healthy, sidecar), "NOTES") == [("kept",)]


def test_repair_of_many_releases(spark):
    sidecar = spark.createDataFrame([("r1", *USA), ("r2", *USA)], "release string, " + META)
    r1 = metadata.attach_series_metadata(facts(spark, "USA", "BEL"), None).withColumn("release", F.lit("r1"))
    kept = spark.createDataFrame([USA[:4] + ("kept", None)], META)
    r2 = metadata.attach_series_metadata(facts(spark, "USA", "BEL"), kept).withColumn("release", F.lit("r2"))
    got = metadata.repair_degraded_releases(r1.unionByName(r2), sidecar, ["release"])
    assert rows(got, "release", "REF_AREA_CODE", "NOTES") == [
        ("r1", "BEL", None), ("r1", "USA", "a note"), ("r2", "BEL", None), ("r2", "USA", "kept"),
    ]


def test_public_metadata(spark):
    side = spark.createDataFrame([USA], META).selectExpr("'F32' TOPIC", "*", "'B' UNIT", "'9' SCALE", "1990 BASE_YEAR")
    got = metadata.public_metadata(side)
    assert got.columns[:3] == ["REF_AREA_CODE", "CONCEPT_CODE", "FREQ_CODE"]
    assert not {"UNIT", "SCALE", "COUNTRY_UPDATE_DATE"} & set(got.columns)
    assert set(dict(got.dtypes).values()) == {"string"}
    with pytest.raises(ValueError, match="1 row.*duplicated"):
        metadata.public_metadata(side.union(side))


def test_public_merge_keeps_fact_columns(spark):
    left = facts(spark, "USA", "BEL").withColumn("NOTES", F.lit("fact"))
    meta = spark.createDataFrame([("USA", "NGDP_RPCH", "A", "F32", "meta")], "REF_AREA_CODE string, CONCEPT_CODE string, FREQ_CODE string, TOPIC string, NOTES string")
    got = metadata.merge_public_metadata(left, meta)
    assert rows(got, "REF_AREA_CODE", "TOPIC", "NOTES") == [("BEL", None, "fact"), ("USA", "F32", "fact")]


# -- positions


def test_ordinal_matches_plain_numbering(spark):
    rng = random.Random(3)
    data = [(g, p, f"v{p}") for g in ("a", "b", None) for p in rng.sample(range(500), 60)]
    df = spark.createDataFrame(data, "g string, p bigint, v string")
    want = sorted(
        ((g, p, i) for g in ("a", "b", None) for i, (_, p) in enumerate(sorted((x, y) for x, y, _ in [(0, d[1], 0) for d in data if d[0] == g]))),
        key=str,
    )
    for chunk in (None, F.floor(F.col("p") / 7), F.floor(F.col("p") / 1000)):
        got = positional.ordinal(df, ["g"], ["p"], "n", chunk)
        assert rows(got, "g", "p", "n") == want


def test_first_occurrences(spark):
    df = spark.createDataFrame([("f", 3, "x"), ("f", 1, "y"), ("f", 2, "x")], "file string, line_no bigint, d string")
    assert rows(positional.first_occurrences(df, ["file"], ["d"], "line_no"), "d", "line_no") == [("x", 2), ("y", 1)]


@pytest.mark.parametrize("how, want", [
    ("full", [("f", 0, "a", "x"), ("f", 1, "b", "y"), ("f", 2, None, "z"), ("g", 0, "c", None)]),
    ("left", [("f", 0, "a", "x"), ("f", 1, "b", "y"), ("g", 0, "c", None)]),
])
def test_pairing(spark, how, want):
    left = spark.createDataFrame([("f", 5, "a"), ("f", 9, "b"), ("g", 1, "c")], "file string, line_no bigint, l string")
    right = spark.createDataFrame([("f", 1, "x"), ("f", 7, "y"), ("f", 8, "z")], "file string, line_no bigint, r string")
    assert rows(positional.pair_by_ordinal(left, right, ["file"], ["line_no"], ["line_no"], how)) == want


def test_without_labels_keeps_unlabelled(spark):
    df = spark.createDataFrame([("Total",), (None,), ("x",)], "l string")
    assert rows(positional.without_labels(df, F.col("l"), ["Total"])) == [("x",), (None,)]


# -- profiles and comparison


def test_profiles(spark):
    df = spark.createDataFrame([("FY2023/24", "n/a"), ("2024", None), ("garbage", "N/A"), ("N/A", "x"), ("garbage", "x")], "y string, t string").withColumn("z", F.lit(None).cast("int"))
    assert rows(profile.unparsed_years(df, "y")) == [("garbage", 2)]
    assert rows(profile.null_profile(df)) == [("t", 5, 1, 2, False), ("y", 5, 0, 1, False), ("z", 5, 5, 0, True)]
    assert rows(profile.match_rate(df, "t")) == [(0.8,)]
    assert rows(profile.fiscal_share(df, "y")) == [(0.2,)]
    assert rows(profile.count_of_token(df, "y", "garbage")) == [(2,)]


def test_first_label(spark):
    df = spark.createDataFrame([(1, "", 1), (1, "b", 3), (1, "a", 2), (2, None, 1)], "c int, l string, o int")
    assert rows(profile.first_label(df, "c", "l", "o")) == [(1, "a")]


def test_parity(spark):
    a = spark.createDataFrame([("x", 1, "U", 1.0), ("y", 1, None, 2.0), ("z", 1, "U", 3.0)], "k string, y int, u string, v double")
    b = spark.createDataFrame([("x", 1, "W", 1.0), ("y", 1, "W", 2.0), ("q", 1, "U", 3.0)], "k string, y int, u string, v double")
    got = reconcile.parity(a, b, ["k", "y"], ["u", "v"], only_where_left=["u"])
    assert rows(got, "k", "in_left", "in_right", "differs") == [
        ("q", False, True, []), ("x", True, True, ["u"]), ("z", True, False, []),
    ]
    assert reconcile.parity(a, a, ["k", "y"], ["u", "v"]).isEmpty()
    assert rows(reconcile.revision_share(a, b, ["k", "y"], "v", 0.5)) == [(2, 0, 0.0)]


# -- releases


def test_flow_labels_and_precedence(spark):
    catalogue = spark.createDataFrame(
        [(0, "WEO", "9.0.0"), (1, "WEO", "10.0.0"), (2, "WEO_2025_OCT_VINTAGE", "1.0.0"), (3, "WEO_2024_OCT_VINTAGE", "1.0.0"),
         (4, "WEO_2024_JUL_VINTAGE", "1.0.0"), (5, "WEO_X", "1"), (6, "FSI", "1")], "pos int, flow_id string, version string")
    probes = spark.createDataFrame(
        [("WEO", "9.0.0", dt.date(2025, 10, 14)), ("WEO", "10.0.0", dt.date(2025, 10, 20)), ("WEO_2025_OCT_VINTAGE", "1.0.0", dt.date(2025, 10, 14))],
        "flow_id string, version string, published date")
    labelled = releases.label_flows(releases.candidate_flows(catalogue), probes)
    assert labelled.count() == 5
    assert rows(releases.preferred_flow(labelled)) == [
        ("October", 2024, "WEO_2024_OCT_VINTAGE", "1.0.0"), ("October", 2025, "WEO", "10.0.0"),
    ]


def test_precedence_tie_keeps_the_earlier(spark):
    df = spark.createDataFrame([(1, "B", "x", False, "April", 2024), (0, "A", "x", False, "April", 2024)],
                               "pos int, flow_id string, version string, is_bare boolean, month string, year int")
    assert rows(releases.preferred_flow(df), "flow_id") == [("A",)]


def frame(spark, items):
    return spark.createDataFrame(items, "month string, year int")


def test_served_and_roll_back(spark):
    api = frame(spark, [("April", 2026), ("October", 2025)])
    bulk = frame(spark, [("April", 2025), ("October", 2023), ("October", 2025), ("April", 2023)])
    served = releases.served_releases(api, bulk, frame(spark, [("October", 2023)]))
    ordered = [tuple(r) for r in releases.newest_first(served).collect()]
    assert ordered == [("April", 2026), ("October", 2025), ("April", 2025), ("April", 2023)]
    assert rows(releases.latest(served)) == [("April", 2026)]
    roll = lambda failed, n=3: [tuple(r) for r in releases.roll_back_candidates(served, failed, n).collect()]
    assert roll(("October", 2025)) == ordered[2:]
    assert roll(("October", 2030), 2) == ordered[:2]


def test_first_existing_path(spark):
    wanted = frame(spark, [("October", 2020), ("April", 2024), ("April", 2019), ("October", 2022)])
    manifest = spark.createDataFrame(
        [("/2020/weooct2020-sdmxdata.zip", 404), ("/2020/02/weooct2020-sdmxdata.zip", 206), ("/2024/april/weoapr2024-sdmxdata.zip", 403),
         ("/2024/weoapr2024-sdmxdata.zip", 200), ("/2022/weooct2022-sdmxdata.zip", 200), ("/2022/october/weooct2022-sdmxdata.zip", 500)],
        "path string, status int")
    assert rows(releases.first_existing_path(wanted, manifest), "year", "path", "outcome") == [
        (2019, None, "no data"), (2020, "/2020/02/weooct2020-sdmxdata.zip", "found"), (2022, "/2022/weooct2022-sdmxdata.zip", "found"),
        (2024, None, "error"),
    ]


# -- code maps


def brute_force(left, right, min_score, min_margin):
    """Outcome per left code by comparing every pair of sets."""
    sets = lambda data: {c: {(f, round(v, 4)) for d, f, v in data if d == c} for c, _, _ in data}
    ls, rs = sets(left), sets(right)
    out = {}
    for code, mine in ls.items():
        scored = sorted(((len(mine & r) / len(mine), len(mine & r), c) for c, r in rs.items() if mine & r), reverse=True)
        best = scored[0] if scored else (0, 0, None)
        second = scored[1][0] if len(scored) > 1 else 0.0
        if scored and best[0] >= min_score and best[0] - second > min_margin:
            out[code] = (len(mine), best[2], best[1], best[0], "mapped")
        else:
            out[code] = (len(mine), None, None, None, "ambiguous" if scored else "unmatched")
    return out, {c: sorted(((len(m & r), k) for k, r in rs.items() if m & r), reverse=True) for c, m in ls.items()}


def random_case(rng):
    """Codes with a hot value, copies, near copies and codes without a partner."""
    left, right = [], []
    for i in range(rng.randint(4, 14)):
        n = rng.randint(1, 8)
        own = [(f"f{rng.randint(0, 9)}", float(rng.choice([0, 0, 1, 2, rng.randint(0, 50)]))) for _ in range(n)]
        left += [(f"L{i}", f, v) for f, v in own]
        for copy in range(rng.choice([0, 1, 1, 1, 2])):
            kept = [x for x in own if rng.random() < rng.choice([0.5, 0.95, 1.0])]
            extra = [(f"f{rng.randint(0, 9)}", float(rng.randint(0, 3))) for _ in range(rng.choice([0, 0, 1]))]
            right += [(f"R{i}_{copy}", f, v) for f, v in kept + extra]
    return left, right or [("R", "f", -1.0)]


def test_code_map_equals_brute_force(spark):
    rng = random.Random(11)
    schema = "code string, f string, v double"
    for min_score, min_margin in itertools.islice(itertools.cycle([(0.9, 0.3), (0.5, 0.1), (0.6, 0.6)]), 8):
        left, right = random_case(rng)
        a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
        want, overlaps = brute_force(left, right, min_score, min_margin)
        a, b = codemap.code_sets(a, "code", ["f"], "v"), codemap.code_sets(b, "code", ["f"], "v")
        got = {r[0]: tuple(r)[1:] for r in codemap.score_codes(a, b, min_score, min_margin).collect()}
        assert got == want
        report = codemap.candidates_for(spark.createDataFrame([(c,) for c in want], "code_left string"), a, b)
        top = {}
        for r in report.orderBy("code_left", "rank").collect():
            top.setdefault(r["code_left"], []).append((r["overlap"], r["code_right"]))
        assert top == {c: o[:3] for c, o in overlaps.items() if o}


def test_code_map_recovers_a_permutation_despite_a_shared_value(spark):
    left = [(f"L{i}", f"f{j}", float(i * 100 + j)) for i in range(40) for j in range(10)] + [(f"L{i}", "z", 0.0) for i in range(40)]
    right = [("G" + c[1:].zfill(3), f, v) for c, f, v in left]
    schema = "code string, f string, v double"
    sides = [codemap.code_sets(spark.createDataFrame(data, schema), "code", ["f"], "v") for data in (left, right)]
    got = codemap.score_codes(*sides)
    assert {(r["code_left"], r["code_right"]) for r in got.collect()} == {(f"L{i}", f"G{i:03d}") for i in range(40)}


def test_attribute_targets(spark):
    left = spark.createDataFrame([("LE", 1, "C", 1.0), ("LE", 2, "N", 2.0), ("X", 1, "A", 1.0), ("X", 2, "A", 2.0), ("Y", 1, "B", 9.0)], "c string, y int, l string, v double")
    right = spark.createDataFrame([("LE", 1, "IX", 1.00001), ("LE", 2, None, 2.0), ("X", 1, "U", 1.0), ("X", 2, "W", 2.0), ("Y", 1, "U", 8.0)], "c string, y int, u string, v double")
    got = codemap.attribute_targets(left, right, ["c", "y"], "v", ["c"], "l", "u")
    assert rows(got, "c", "l", "n_targets", "target") == [("LE", "C", 1, "IX"), ("X", "A", 2, "U")]


def test_resolve_attributes(spark):
    pairs = spark.createDataFrame([("A", "1", "Percent"), ("B", "1", "Index"), ("C", "1", "Persons"), ("D", "1", "None"), ("E", "1", None)], "concept string, letter string, label string")
    matched = spark.createDataFrame([("A", "1", "USD")], "concept string, letter string, unit string")
    decided = spark.createDataFrame([("B", "1", "no"), ("C", "1", "PE"), ("D", "1", None)], "concept string, letter string, unit string")
    got = codemap.resolve_attributes(pairs, matched, decided, ["concept", "letter"])
    assert rows(got, "concept", "unit", "source") == [
        ("A", "USD", "matched"), ("B", "IX", "label"), ("C", "PE", "override"), ("D", None, "no unit"), ("E", None, "unexplained"),
    ]


# -- observations


def test_drop_empty_is_idempotent_and_melt(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)], "k string, OBS_VALUE double, w double")
    once = observations.drop_empty(df)
    assert rows(observations.drop_empty(once)) == rows(once) == [("a", 1.0, None)]
    assert rows(observations.melt(df, ["k"], ["OBS_VALUE", "w"])) == [
        ("a", "OBS_VALUE", 1.0), ("a", "w", None), ("b", "OBS_VALUE", None), ("b", "w", 2.0),
    ]


def test_concat_releases(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(observations.concat_releases([a, b])) == [(1, "x"), (2, "y")]
