"""Derive the translation tables by comparing one release that both sources carry."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.dates import release_ordinal
from macroloom.functions.text import aggregate_code
from macroloom.operators.codemap import (
    MIN_MARGIN,
    MIN_SCORE,
    attribute_targets,
    candidates_for,
    code_sets,
    missing_codes,
    resolve_attributes,
    score_codes,
)
from macroloom.operators.lookup import lookup, require_one_to_one, strict_inverse
from macroloom.operators.observations import named
from macroloom.operators.profile import first_label
from macroloom.schema import UNIT_MAP_SCHEMA
from macroloom.work import inline, refuse_rows, stored
from macroloom.vocabulary_values import BULK_ONLY_AREAS, UNIT_DECISIONS

FEATURES = ["CONCEPT_CODE", "TIME_PERIOD"]


def usable(releases: DataFrame) -> DataFrame:
    """Rows with a value and an area."""
    return releases.dropna(subset=["OBS_VALUE", "REF_AREA_CODE"])


def area_map_by_value(bulk, api, min_score=MIN_SCORE, min_margin=MIN_MARGIN) -> DataFrame:
    """(legacy, code) of every area whose reported values single out one code.

    ValueError, with the closest candidates, when any area is ambiguous: the closest one is never
    taken as a guess. Areas that share no value with any code are left out.
    """
    left = code_sets(bulk, "REF_AREA_CODE", FEATURES, "OBS_VALUE")
    right = code_sets(api, "REF_AREA_CODE", FEATURES, "OBS_VALUE")
    scores = stored(score_codes(left, right, min_score, min_margin), "area-scores")
    ambiguous = scores.filter("outcome = 'ambiguous'").select("code_left")
    if not ambiguous.isEmpty():
        refuse_rows(candidates_for(ambiguous, left, right), "Ambiguous area matches")
    area_map = scores.filter("outcome = 'mapped'").select(
        F.col("code_left").cast("int").alias("legacy"), F.col("code_right").alias("code")
    )
    require_one_to_one(area_map, "code")
    return area_map


def extend_area_map(releases, area_map, expected=tuple(BULK_ONLY_AREAS)):
    """Area map and labels with the aggregates that only the bulk releases have.

    Any other area without a code, and a made-up code that is already in use, is a ValueError.
    """
    spark = releases.sparkSession
    expected_codes = inline(spark, [(int(c),) for c in expected], "legacy int")
    codes = releases.select(F.col("REF_AREA_CODE").cast("int").alias("legacy"))
    refuse_rows(missing_codes(codes, area_map, expected_codes), "Areas without a code")
    made_up = expected_codes.withColumn("code", aggregate_code(F.col("legacy")))
    refuse_rows(made_up.join(area_map.select("code"), "code", "left_semi"), "Aggregate codes already in use")
    ordered = releases.withColumn("__age", release_ordinal(F.col("release_month"), F.col("release_year")))
    of_expected = ordered.join(expected_codes, F.col("REF_AREA_CODE") == F.col("legacy"), "left_semi")
    labels = first_label(of_expected, "REF_AREA_CODE", "REF_AREA_LABEL", "__age")
    labelled = made_up.join(labels, F.col("legacy") == F.col("REF_AREA_CODE")).select(
        "code", F.col("REF_AREA_LABEL").alias("label")
    )
    return area_map.select("legacy", "code").unionByName(made_up), labelled


def unit_map_by_value(bulk, api, area_map) -> DataFrame:
    """(concept, letter, unit) of pairs whose rows all meet one unit; two units are a ValueError."""
    translated = lookup(bulk, area_map, {"REF_AREA_CODE": "legacy"}, {"code": "REF_AREA_CODE"})
    # One row per pair of concept and letter, read three times from here on.
    targets = stored(
        attribute_targets(
            translated.withColumnRenamed("UNIT_CODE", "letter"),
            api.withColumnRenamed("UNIT_CODE", "unit"),
            ["CONCEPT_CODE", "REF_AREA_CODE", "TIME_PERIOD"],
            "OBS_VALUE",
            ["CONCEPT_CODE"],
            "letter",
            "unit",
        ),
        "unit-targets",
    )
    refuse_rows(targets.filter("n_targets > 1"), "Ambiguous unit pairs")
    return targets.select(F.col("CONCEPT_CODE").alias("concept"), "letter", F.col("target").alias("unit"))


def observed_pairs(releases: DataFrame) -> DataFrame:
    """(concept, letter, label) over all releases with the label of the earliest one."""
    age = release_ordinal(F.col("release_month"), F.col("release_year"))
    first = F.min_by(F.struct("label"), F.struct("age", "label"))
    # Distinct rows come by hashing; the earliest of the few that are left by sorting.
    seen = releases.select(F.col("CONCEPT_CODE").alias("concept"), F.col("UNIT_CODE").alias("letter"), F.col("UNIT_LABEL").alias("label"), age.alias("age"))
    return seen.distinct().groupBy("concept", "letter").agg(first["label"].alias("label"))


def extend_unit_map(releases, matched, decisions=None) -> DataFrame:
    """(concept, letter, unit) for every observed pair and every pair decided to have no unit, each once.

    What the values or the label of a pair say comes before a decision that it has no unit.
    """
    spark = releases.sparkSession
    decided = inline(spark, UNIT_DECISIONS, UNIT_MAP_SCHEMA) if decisions is None else decisions
    resolved = stored(resolve_attributes(observed_pairs(releases), matched, decided, ["concept", "letter"]), "unit-pairs")
    refuse_rows(resolved.filter("source = 'unexplained'"), "Unit pairs nothing explains")
    pair = ["concept", "letter"]
    seen = matched.select(*pair, "unit")
    seen = seen.unionByName(resolved.select(*pair, "unit").join(matched.select(*pair), pair, "left_anti"))
    without = decided.filter("unit is null").select(*pair, "unit").distinct()
    return seen.unionByName(without.join(seen.select(*pair), pair, "left_anti"))


def derive_vocabulary(releases, api, anchor, min_score=MIN_SCORE, min_margin=MIN_MARGIN, decisions=None, bulk_only=None):
    """The four tables of the vocabulary.

    ``releases`` are parsed bulk releases stacked with ``release_month`` and ``release_year``;
    ``api`` is the aligned frame of the ``anchor`` release, which the stack holds too.
    Returns area_map, area_map_inverse, unit_map and legacy_labels by name.
    """
    month, year = anchor
    releases = usable(releases)
    bulk = releases.filter((F.col("release_month") == month) & (F.col("release_year") == year))
    api = api.dropna(subset=["OBS_VALUE"])
    anchored = area_map_by_value(bulk, api, min_score, min_margin)
    area_map, labels = extend_area_map(releases, anchored, tuple(BULK_ONLY_AREAS) if bulk_only is None else bulk_only)
    units = unit_map_by_value(bulk, api, anchored)
    return {
        "area_map": area_map,
        "area_map_inverse": strict_inverse(area_map, "legacy", "code"),
        "unit_map": extend_unit_map(releases, units, decisions),
        "legacy_labels": labels,
    }


def write_vocabulary(tables: dict, root: str) -> None:
    """Each table sorted by its key, as Parquet."""
    keys = {"area_map": ["legacy"], "area_map_inverse": ["code"], "unit_map": ["concept", "letter"], "legacy_labels": ["code"]}
    for name, table in tables.items():
        table.orderBy(*[named(k) for k in keys[name]]).write.mode("overwrite").parquet(f"{root}/{name}")
