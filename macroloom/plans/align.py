"""Observation feed to the contract: drop, rename, look up, scale, type, project."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.numbers import real, scale_multiplier, scale_name, scaled, whole
from macroloom.operators.lookup import labels_of, lookup
from macroloom.operators.observations import contract, drop_empty, named
from macroloom.schema import ALIGNED_COLUMNS, FEED_RENAMES, LABEL_CODELISTS


def convert_values(df: DataFrame) -> DataFrame:
    """Scale label from the exponent, value in scale, exponent to multiplier, typed year.

    A value that is no number becomes null on a row that is scaled and is an error on one that
    is not.
    """
    df = df.withColumns({"__exponent": real(F.col("SCALE_CODE")), "__value": real(F.col("OBS_VALUE"))})
    exponent, value = F.col("__exponent"), F.col("__value")
    unreadable = F.col("OBS_VALUE").isNotNull() & value.isNull()
    strict = F.when(
        unreadable, F.raise_error(F.concat(F.lit("Not a number: "), F.col("OBS_VALUE"))).cast("double")
    ).otherwise(value)
    return df.withColumns(
        {
            "SCALE_LABEL": scale_name(exponent),
            "OBS_VALUE": F.when(exponent > 0, scaled(value, exponent)).otherwise(strict),
            "SCALE_CODE": scale_multiplier(exponent),
            "TIME_PERIOD": whole(real(F.col("TIME_PERIOD")), "int"),
        }
    ).drop("__exponent", "__value")


def align_observations(df: DataFrame, codelists: DataFrame, area_map: DataFrame, keep=()) -> DataFrame:
    """The 13 contract columns an observation file can supply, plus the ``keep`` columns.

    Row-local apart from lookups, so it runs over any number of releases at once and on a
    stream. ``codelists`` is (agency, codelist_id, code, label), ``area_map`` (legacy, code).
    """
    df = drop_empty(df).withColumnsRenamed(FEED_RENAMES)
    df = df.withColumns({c: named(c).cast("string") for c in ["SCALE_CODE", "OBS_VALUE", "TIME_PERIOD"]})
    df = lookup(df, area_map, {"REF_AREA_CODE": "code"}, {"legacy": "REF_AREA_IMF_CODE"})
    for prefix, (agency, codelist) in LABEL_CODELISTS.items():
        labels = labels_of(codelists, agency, codelist)
        df = lookup(df, labels, {f"{prefix}_CODE": "code"}, {"label": f"{prefix}_LABEL"})
    return contract(convert_values(df), [*ALIGNED_COLUMNS, *keep])
