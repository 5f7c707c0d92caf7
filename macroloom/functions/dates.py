"""Dates, years and release labels as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from macroloom.functions.text import null_if_not_applicable

ACTUAL_YEAR = r"^(?:FY([0-9]{4})/[0-9]{2}|([0-9]{4}))$"
VINTAGE_ID = r"^WEO_([0-9]{4})_([A-Z]{3})_VINTAGE$"


def actual_year(value: Column) -> Column:
    """Leading year of ``2024`` or ``FY2023/24``; everything else is null."""
    known = null_if_not_applicable(value)
    fiscal = F.nullif(F.regexp_extract(known, ACTUAL_YEAR, 1), F.lit(""))
    plain = F.nullif(F.regexp_extract(known, ACTUAL_YEAR, 2), F.lit(""))
    return F.coalesce(fiscal, plain).try_cast("int")


def is_fiscal_year(value: Column) -> Column:
    return value.rlike(r"^FY[0-9]{4}/[0-9]{2}$")


def us_date(value: Column) -> Column:
    """``M/d/yyyy`` text to a zone-less timestamp; anything else is null."""
    return F.try_to_date(value, "M/d/yyyy").cast("timestamp_ntz")


def long_date(value: Column) -> Column:
    """``November 30, 2023`` to a date; anything else is null."""
    return F.try_to_date(value, "MMMM d, yyyy")


#: Forms of a publication date, the likeliest first; of day and month in figures the month comes first.
PUBLISHED_FORMS = ["yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "M-d-yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-MM", "yyyy"]


def published_date(value: Column) -> Column:
    """Publication date in any usual form, with or without a time behind it; anything else is null."""
    day = F.regexp_replace(F.trim(value), r"(?:[T ]+[0-9]{1,2}:[0-9]{2}.*)$", "")
    return F.coalesce(*[F.try_to_date(day, form) for form in PUBLISHED_FORMS])


def feed_date(value: Column, patterns) -> Column:
    """First of ``patterns`` that parses; text no pattern parses fails the job."""
    parsed = F.coalesce(*[F.try_to_date(value, p) for p in patterns])
    return F.when(value.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("Unparseable date: "), value)).cast("date")
    )


def month_end(year: Column, month: Column) -> Column:
    """Last calendar day; a month outside 1..12 fails the job."""
    return F.last_day(F.make_date(year, month, F.lit(1)))


def month_end_text(year: Column, month: Column) -> Column:
    """Month end without zero padding, e.g. ``2024-2-29``."""
    return F.date_format(month_end(year, month), "yyyy-M-d")


def release_month(published: Column) -> Column:
    """Release a publication date belongs to: first half-year April, second October."""
    return F.when(F.month(published) < 7, "April").otherwise("October")


def vintage_year(flow_id: Column) -> Column:
    return F.nullif(F.regexp_extract(flow_id, VINTAGE_ID, 1), F.lit("")).try_cast("int")


def vintage_month(flow_id: Column) -> Column:
    """Release month of an archival flow id, null for a month code that is not a release month."""
    code = F.regexp_extract(flow_id, VINTAGE_ID, 2)
    return F.when(code == "APR", "April").when(code == "OCT", "October")


def version_key(version: Column) -> Column:
    """Dotted version as an integer array, which orders numerically; ``[0]`` if it does not parse."""
    parts = F.transform(F.split(version, "[.]"), lambda p: p.try_cast("int"))
    return F.when(F.exists(parts, lambda p: p.isNull()) | version.isNull(), F.array(F.lit(0))).otherwise(parts)


def expected_release(day: Column):
    """(month, year) expected to be the newest release on ``day``."""
    month = F.when((F.month(day) >= 4) & (F.month(day) < 10), "April").otherwise("October")
    year = F.when(F.month(day) < 4, F.year(day) - 1).otherwise(F.year(day))
    return month, year


def tidy_month(value: Column) -> Column:
    """Month name trimmed and capitalised, null when it is not a release month."""
    name = F.initcap(F.trim(value))
    return F.when(name.isin("April", "October"), name)


def tidy_year(value: Column) -> Column:
    return F.trim(value).try_cast("int")


def release_ordinal(month: Column, year: Column) -> Column:
    """Integer that orders releases: October of a year after its April."""
    return year * 2 + F.when(month == "October", 1).otherwise(0)
