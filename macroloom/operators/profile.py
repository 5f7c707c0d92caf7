"""Profiles of observation and metadata frames: one aggregate pass each."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.dates import actual_year, is_fiscal_year
from macroloom.functions.text import null_if_not_applicable
from macroloom.operators.observations import named


def catalogue(df: DataFrame, *columns) -> DataFrame:
    """Distinct combinations, such as every concept with its label."""
    return df.select(*[named(c) for c in columns]).distinct()


def count_of_token(df: DataFrame, column: str, token: str = "--", out="n") -> DataFrame:
    """Number of cells that hold exactly ``token``."""
    return df.agg(F.count_if(named(column) == token).alias(out))


def unparsed_years(df: DataFrame, column: str) -> DataFrame:
    """(token, n): texts that are neither a year, a fiscal year nor ``N/A``, largest count first."""
    known = null_if_not_applicable(named(column))
    bad = df.select(known.alias("token")).filter(F.col("token").isNotNull() & actual_year(F.col("token")).isNull())
    return bad.groupBy("token").agg(F.count("*").alias("n"))


def coverage(df: DataFrame, concept="CONCEPT_CODE", area="REF_AREA_CODE", period="TIME_PERIOD", by=()) -> DataFrame:
    """Rows, distinct concepts and areas, first and last period (optionally per release)."""
    return df.groupBy(*[named(b) for b in by]).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(named(concept)).alias("n_concepts"),
        F.count_distinct(named(area)).alias("n_areas"),
        F.min(named(period)).alias("first_period"),
        F.max(named(period)).alias("last_period"),
    )


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Per column: rows, nulls, whether it is null throughout, and literal ``N/A`` cells."""
    columns = columns or df.columns
    wide = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(named(c).isNull()).alias(f"__null{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.upper(named(c).cast("string")) == "N/A").alias(f"__na{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"__null{i}").alias("n_null"), F.col(f"__na{i}").alias("n_na"))
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.col("__rows").alias("n_rows"), F.inline(entries)).select(
        "column", "n_rows", "n_null", "n_na", (F.col("n_rows") == F.col("n_null")).alias("all_null")
    )


def match_rate(df: DataFrame, column: str, out="match_rate") -> DataFrame:
    """Share of rows whose metadata is present."""
    return df.agg(F.avg(named(column).isNotNull().cast("int")).alias(out))


def fiscal_share(df: DataFrame, column: str, out="fiscal_share") -> DataFrame:
    """Share of populated series that are reported by fiscal year."""
    return df.filter(named(column).isNotNull()).agg(F.avg(is_fiscal_year(named(column)).cast("int")).alias(out))


def first_label(df: DataFrame, code: str, label: str, release_order: str) -> DataFrame:
    """Earliest non-empty label of every code across releases."""
    usable = df.filter(named(label).isNotNull() & (named(label) != ""))
    usable = usable.select(named(code), named(label), named(release_order)).distinct()
    return usable.groupBy(named(code)).agg(F.min_by(named(label), F.struct(named(release_order), named(label))).alias(label))
