"""SDMX XML: series with their observations, and the code lists of the schema file."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.schema import BULK_OBS_ATTRIBUTES, BULK_SERIES_ATTRIBUTES

# Attribute names are kept bare, and their text is kept as it is.
XML_OPTIONS = {"attributePrefix": "", "ignoreSurroundingSpaces": "false", "rowTag": "Series", "mode": "FAILFAST"}
SIMPLE_TYPE = (
    "_name string, `xs:restriction` struct<`xs:enumeration`: array<struct<_value: string,"
    " `xs:annotation`: struct<`xs:documentation`: string>>>>"
)


def series_type(series_attributes=tuple(BULK_SERIES_ATTRIBUTES), obs_attributes=tuple(BULK_OBS_ATTRIBUTES)) -> str:
    obs = ", ".join(f"{a}: string" for a in obs_attributes)
    return ", ".join(f"{a} string" for a in series_attributes) + f", Obs array<struct<{obs}>>"


def parse_series(xml: Column, **attributes) -> Column:
    """One ``<Series>`` element as a struct. A malformed one fails the job: dropping it would lose its observations."""
    return F.from_xml(xml, series_type(**attributes), XML_OPTIONS)


def series_to_rows(df: DataFrame, keep=(), obs_attributes=tuple(BULK_OBS_ATTRIBUTES)) -> DataFrame:
    """One row per observation carrying its series' attributes.

    A series without observations vanishes; of an attribute both levels have, the
    observation's value counts.
    """
    rest = [c for c in df.columns if c != "Obs" and c not in keep and c not in obs_attributes]
    both = [c for c in df.columns if c in obs_attributes]
    # The outer form, because for the inner one Spark adds a filter on the array below, which
    # would parse every element a second time.
    opened = df.select(*keep, *rest, *[F.col(c).alias(f"__series_{c}") for c in both], F.explode_outer("Obs").alias("o"))
    renamed = opened.filter(F.col("o").isNotNull())
    obs = [
        F.coalesce(F.col(f"o.{a}"), F.col(f"__series_{a}")).alias(a) if a in both else F.col(f"o.{a}").alias(a)
        for a in obs_attributes
    ]
    return renamed.select(*keep, *rest, *obs)


def scan_series(spark: SparkSession, path, **attributes) -> DataFrame:
    """Observations of unpacked XML files.

    Spark's XML source reads a file in one task, so the file is read as text that is cut at the
    end tags of series, which splits it like any other text. A series without observations is
    self-closing and ends up in front of the next one, where it is skipped.
    """
    text = F.col("value")
    element = F.concat(F.lit("<Series"), F.substring_index(text, "<Series", -1), F.lit("</Series>"))
    pieces = spark.read.text(path, lineSep="</Series>").filter(text.contains("<Series"))
    return series_to_rows(pieces.select(parse_series(element, **attributes).alias("s")).select("s.*"))


def enumerations(raw: DataFrame, keep=()) -> DataFrame:
    """(keep.., codelist_id, code, label) from parsed simple types; of a repeated code the last counts."""
    rows = raw.select(
        *keep, F.col("_name").alias("codelist_id"), F.posexplode_outer("`xs:restriction`.`xs:enumeration`").alias("pos", "e")
    ).filter(F.col("e").isNotNull())
    label = F.col("e.`xs:annotation`.`xs:documentation`")
    last = F.max_by(F.struct(label.alias("label")), F.col("pos"))["label"].alias("label")
    return rows.groupBy(*keep, "codelist_id", F.col("e._value").alias("code")).agg(last)


def scan_schema_codes(spark: SparkSession, path) -> DataFrame:
    """Code lists of unpacked schema files."""
    reader = spark.read.format("xml").option("rowTag", "xs:simpleType").option("mode", "FAILFAST").schema(SIMPLE_TYPE)
    return enumerations(reader.load(path))


def parse_simple_type(xml: Column) -> Column:
    return F.from_xml(xml, SIMPLE_TYPE, {"rowTag": "xs:simpleType", "mode": "FAILFAST"})
