"""The three line-oriented drawing-rights feeds.

Each takes numbered lines (file, line_no, value), one file or many, and returns the feed's rows
with the file they came from. Line 0 of a file is its title.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.functions.dates import feed_date, month_end
from macroloom.functions.labels import rate_label
from macroloom.functions.numbers import digits_only_real, real
from macroloom.functions.text import field, fields
from macroloom.operators.lookup import lookup
from macroloom.operators.observations import melt
from macroloom.operators.positional import header_positions, pair_classes, require_columns, without_labels
from macroloom.work import stored

# Fixed values of the feeds: labels that are matched, columns that have to be there.
INTEREST_LABEL = "SDR Interest Rate"
INTEREST_SKIPPED = ["Total", "Floor for SDR Interest Rate"]
INTEREST_COLUMNS = {"Effective from": "from_at", "Effective to": "to_at"}
EXCHANGE_COLUMNS = {"Report date": "label_at"}
HOLDINGS_PREFACE = 4

# Dates are read month first; ISO and spelled-out forms are what the feeds also use.
DATE_PATTERNS = ["M/d/yyyy", "yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy", "d-MMM-yyyy"]


def with_header_columns(lines: DataFrame, wanted: dict, check: bool) -> DataFrame:
    """Rows below the header line as ``parts``, with the index of each wanted column.

    The check reads the header lines beforehand. Where all files have their columns in the same
    places, which is the rule, the places are constants and no join is needed.
    """
    split = lines.select("file", "line_no", fields(F.col("value")).alias("parts"))
    headers = split.filter("line_no = 1").select("file", F.col("parts").alias("header"))
    positions = header_positions(headers, "header", wanted)
    constant = require_columns(positions, wanted) if check else None
    rows = split.filter("line_no > 1")
    if constant:
        return rows.withColumns({out: F.lit(at).cast("int") for out, at in constant.items()})
    return lookup(rows, positions, {"file": "file"}, {out: out for out in wanted.values()})


def exchange_rates(lines: DataFrame, unit_basis="SDR", check=True, date_patterns=DATE_PATTERNS) -> DataFrame:
    """(file, ordinal, date, exchange_rate): the k-th distinct date beside the k-th rate."""
    label = rate_label(unit_basis)
    rows = with_header_columns(lines, EXCHANGE_COLUMNS, check)
    parts, none = F.col("parts"), F.lit(None).cast("string")
    # A line may be both: a dated row counts once per date, a rate row for itself.
    dated = F.when(field(parts, 3).isNotNull(), _entry(True, field(parts, 0), none, F.lit(None).cast("bigint")))
    rate = F.when(F.get(parts, F.col("label_at")) == label, _entry(False, none, F.get(parts, F.lit(1)), F.col("line_no")))
    found = rows.select("file", "line_no", F.explode(F.array_compact(F.array(dated, rate))).alias("e")).select("file", "line_no", "e.*")
    paired = pair_classes(_first_lines(found, ["date", "exchange_rate"]), ["file"], "line_no", ["date"], ["exchange_rate"], "full")
    return paired.withColumns(
        {"date": feed_date(F.col("date"), date_patterns), "exchange_rate": real(F.col("exchange_rate"))}
    )


def _entry(is_left, date, rate, own):
    return F.struct(F.lit(is_left).alias("is_left"), date.alias("date"), rate.alias("exchange_rate"), own.alias("own"))


def _first_lines(found: DataFrame, columns) -> DataFrame:
    """Distinct values of each class with the line they are first seen on; stored, as numbering reads them twice."""
    return stored(found.groupBy("file", "is_left", "own", *columns).agg(F.min("line_no").alias("line_no")), "feed-entries")


def interest_rows(lines: DataFrame, check=True) -> DataFrame:
    """(file, line_no, effective_from, effective_to) of lines that have a second field."""
    rows = with_header_columns(lines, INTEREST_COLUMNS, check)
    parts = F.col("parts")
    return rows.select(
        "file",
        "line_no",
        field(parts, F.col("from_at")).alias("effective_from"),
        field(parts, F.col("to_at")).alias("effective_to"),
    ).dropna(subset=["effective_to"])


def interest_rates(lines: DataFrame, check=True, date_patterns=DATE_PATTERNS) -> DataFrame:
    """(file, ordinal, interest_rate, effective_from, effective_to): one row per published rate."""
    rows = without_labels(interest_rows(lines, check), F.col("effective_from"), INTEREST_SKIPPED)
    is_rate = F.coalesce(F.col("effective_from") == INTEREST_LABEL, F.lit(False))
    found = rows.select(
        "file",
        "line_no",
        is_rate.alias("is_left"),
        F.when(is_rate, F.col("line_no")).alias("own"),
        F.when(is_rate, F.col("effective_to")).alias("interest_rate"),
        F.when(~is_rate, F.col("effective_from")).alias("effective_from"),
        F.when(~is_rate, F.col("effective_to")).alias("effective_to"),
    )
    periods = ["effective_from", "effective_to"]
    paired = pair_classes(_first_lines(found, ["interest_rate", *periods]), ["file"], "line_no", ["interest_rate"], periods, "left")
    return paired.withColumns(
        {
            "interest_rate": real(F.col("interest_rate")),
            "effective_from": feed_date(F.col("effective_from"), date_patterns),
            "effective_to": feed_date(F.col("effective_to"), date_patterns),
        }
    )


def holdings_rows(lines: DataFrame) -> DataFrame:
    """(file, entity, holdings, allocations) below the preface; a fourth field is an error."""
    parts = fields(F.col("value"))
    body = lines.filter(F.col("line_no") >= HOLDINGS_PREFACE).select("file", parts.alias("parts"))
    entity = F.when(F.size("parts") <= 3, field(F.col("parts"), 0)).otherwise(
        F.raise_error(F.concat(F.lit("More than three fields: "), F.array_join("parts", " | "))).cast("string")
    )
    return body.select(
        "file",
        entity.alias("entity"),
        digits_only_real(field(F.col("parts"), 1)).alias("holdings"),
        digits_only_real(field(F.col("parts"), 2)).alias("allocations"),
    )


def holdings(lines: DataFrame, year, month) -> DataFrame:
    """(file, entity, indicator, value, date): long form, dated at the end of the month.

    ``year`` and ``month`` are columns over ``file``, so many months are read in one job.
    """
    long = melt(holdings_rows(lines), ["file", "entity"], ["holdings", "allocations"])
    return long.withColumn("date", month_end(year, month))
