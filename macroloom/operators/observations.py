"""Projections, filters and reshapes of observation frames."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.schema import CONTRACT_COLUMNS, ENVELOPE_COLUMNS, METADATA_FIELDS, OBSERVATION_SCHEMA


def named(column: str):
    """Column by literal name, whatever characters the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def drop_empty(df: DataFrame, value: str = "OBS_VALUE") -> DataFrame:
    """Drop rows without a value."""
    return df.dropna(subset=[value])


def contract(df: DataFrame, columns=CONTRACT_COLUMNS) -> DataFrame:
    """Final ordered projection; contract columns are cast to their contract types."""
    types = {f.name: f.dataType for f in OBSERVATION_SCHEMA}
    return df.select(*[named(c).cast(types[c]).alias(c) if c in types else named(c) for c in columns])


def observation_slice(df, area=None, concept=None, years=None) -> DataFrame:
    """Rows of one area and/or concept within an inclusive range of years."""
    if area is not None:
        df = df.filter(F.col("REF_AREA_CODE") == area)
    if concept is not None:
        df = df.filter(F.col("CONCEPT_CODE") == concept)
    if years is not None:
        df = df.filter(F.col("TIME_PERIOD").between(*years))
    return df


def with_null_metadata(df: DataFrame) -> DataFrame:
    """The three metadata columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in METADATA_FIELDS.items()})


def plain_headers(df: DataFrame) -> DataFrame:
    """Strip a trailing ``[...]`` marker from every header; ValueError when two then coincide."""
    seen = {}
    for header in df.columns:
        bare = re.sub(r"\[[^\]]*\]$", "", header)
        if bare in seen:
            raise ValueError(f"Columns {seen[bare]!r} and {header!r} both normalise to {bare!r}")
        seen[bare] = header
    return df.toDF(*seen)


def drop_envelope(df: DataFrame) -> DataFrame:
    """Drop message-envelope columns; unknown columns pass through."""
    return df.drop(*ENVELOPE_COLUMNS)


def keys_first_text(df: DataFrame, keys) -> DataFrame:
    """Keys in front, every column as text."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*[named(c).cast("string").alias(c) for c in [*keys, *rest]])


def melt(df: DataFrame, ids, values, name="indicator", value="value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(ids, values, name, value)


def concat_releases(frames) -> DataFrame:
    """Stack releases by column name; a column one of them lacks is null there."""
    frames = list(frames)
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
