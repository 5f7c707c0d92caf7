"""Bulk-archive vocabulary to the one every release is served in."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.operators.lookup import label_with_fallback, labels_of, lookup, strict_lookup
from macroloom.operators.observations import contract, drop_empty
from macroloom.schema import CONTRACT_COLUMNS, LABEL_CODELISTS, METADATA_FIELDS


def translate_release(df, codelists, area_map, unit_map, legacy_labels, check=True, keep=()) -> DataFrame:
    """Translate area and unit codes strictly and read their labels from the code lists.

    ``unit_map`` holds the pairs that deliberately have no unit with a null ``unit``; any pair it
    does not hold, and any area ``area_map`` does not hold, is an error. Values, scales and the
    labels of frequency and scale stay as published.
    """
    df = drop_empty(df).withColumn("REF_AREA_IMF_CODE", F.col("REF_AREA_CODE"))
    df = strict_lookup(
        df, area_map, {"REF_AREA_CODE": "legacy"}, {"code": "REF_AREA_CODE"}, "REF_AREA_CODE values", check
    )
    df = strict_lookup(
        df,
        unit_map,
        {"CONCEPT_CODE": "concept", "UNIT_CODE": "letter"},
        {"unit": "UNIT_CODE"},
        "(CONCEPT_CODE, UNIT_CODE) pairs",
        check,
    )
    areas = labels_of(codelists, *LABEL_CODELISTS["REF_AREA"])
    df = label_with_fallback(df, areas, legacy_labels, "REF_AREA_CODE", "REF_AREA_LABEL")
    for prefix in ("UNIT", "CONCEPT"):
        labels = labels_of(codelists, *LABEL_CODELISTS[prefix])
        df = lookup(df, labels, {f"{prefix}_CODE": "code"}, {"label": f"{prefix}_LABEL"})
    df = df.withColumn("COUNTRY_UPDATE_DATE", F.lit(None).cast(METADATA_FIELDS["COUNTRY_UPDATE_DATE"]))
    return contract(df, [*CONTRACT_COLUMNS, *keep, *(["__faults"] if check == "flag" else [])])
