"""Serving drawing-rights (SDR) feeds from landed files.

Layout under the landing root::

    sdr/holdings/<year>-<month>-<day>.tsv   holdings and allocations at a month end
    sdr/exchange/*.tsv                      exchange rates, the whole history per file
    sdr/interest/*.tsv                      interest rates, the whole history per file
    sdr/pages/*.html                        announcement page
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroloom.functions.dates import month_end_text
from macroloom.functions.labels import check_month_served, rate_label
from macroloom.plans import reserves_feeds as feeds
from macroloom.sources.pages import announced_date
from macroloom.sources.snapshots import PARTITIONS, WEEK, fresh, keyed, read_snapshot, write_snapshot
from macroloom.sources.text_lines import scan_lines
from macroloom.work import landed


def _newest(spark, folder, pattern) -> str:
    row = landed(spark, folder, pattern).agg(F.max_by("path", F.struct("modified", "path")).alias("path")).first()
    if row["path"] is None:
        raise ValueError(f"Could not parse data: nothing is landed under {folder}")
    return row["path"]


def _lines(spark, path) -> DataFrame:
    lines = scan_lines(spark, path)
    if lines.isEmpty():
        raise ValueError(f"Could not parse data: {path} is empty")
    return lines


def fetch_exchange_rates(spark: SparkSession, root: str, unit_basis: str = "SDR") -> DataFrame:
    """(date, exchange_rate) of the newest landed file."""
    rate_label(unit_basis)
    lines = _lines(spark, _newest(spark, f"{root}/sdr/exchange", "*.tsv"))
    return feeds.exchange_rates(lines, unit_basis).select("date", "exchange_rate")


def fetch_interest_rates(spark: SparkSession, root: str) -> DataFrame:
    """(interest_rate, effective_from, effective_to) of the newest landed file."""
    lines = _lines(spark, _newest(spark, f"{root}/sdr/interest", "*.tsv"))
    return feeds.interest_rates(lines).select("interest_rate", "effective_from", "effective_to")


def fetch_latest_allocations_holdings_date(spark: SparkSession, root: str) -> tuple:
    """(year, month) the newest landed announcement page names."""
    path = _newest(spark, f"{root}/sdr/pages", "*.html")
    page = spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")
    row = announced_date(page).select("announced", "problem").first()
    if row["problem"] is not None:
        raise ValueError(f"Unexpected SDR page layout at {path}: {row['problem']}")
    return row["announced"].year, row["announced"].month


def all_allocations_holdings(spark: SparkSession, root: str) -> DataFrame:
    """Every landed month in one frame: (entity, indicator, value, date)."""
    lines = scan_lines(spark, f"{root}/sdr/holdings", "*.tsv")
    part = lambda i: F.regexp_extract("file", r"([0-9]{4})-([0-9]{1,2})-[0-9]{1,2}\.tsv$", i).cast("int")
    return feeds.holdings(lines, part(1), part(2)).drop("file")


def fetch_allocations_holdings(spark: SparkSession, root: str, date: tuple | None = None) -> DataFrame:
    """(entity, indicator, value, date) of a (year, month), by default the latest one announced."""
    latest = fetch_latest_allocations_holdings_date(spark, root)
    date = latest if date is None else tuple(date)
    check_month_served(date, latest)
    year, month = F.lit(date[0]), F.lit(date[1])
    name = spark.range(1).select(month_end_text(year, month)).first()[0]
    path = f"{root}/sdr/holdings/{name}.tsv"
    if landed(spark, f"{root}/sdr/holdings", f"{name}.tsv").isEmpty():
        raise ValueError(f"SDR data not available for this date: {path}")
    return feeds.holdings(_lines(spark, path), year, month).drop("file")


#: Sublayer of the snapshot store that each dataset has.
SUBLAYERS = {"exchange_sdr": "sdr_exchange_sdr", "exchange_usd": "sdr_exchange_usd", "interest": "sdr_interest", "holdings": "sdr_holdings"}


def ingest(spark: SparkSession, root: str, store: str) -> list:
    """Write every landed feed to the snapshot store; the datasets written, those with nothing landed left out."""
    reads = {
        "exchange_sdr": lambda: fetch_exchange_rates(spark, root, "SDR"),
        "exchange_usd": lambda: fetch_exchange_rates(spark, root, "USD"),
        "interest": lambda: fetch_interest_rates(spark, root),
        "holdings": lambda: all_allocations_holdings(spark, root),
    }
    folders = {"exchange_sdr": "exchange", "exchange_usd": "exchange", "interest": "interest", "holdings": "holdings"}
    there = {name: not landed(spark, f"{root}/sdr/{folder}", "*.tsv").isEmpty() for name, folder in folders.items()}
    for name in (n for n in reads if there[n]):
        write_snapshot(keyed(reads[name](), sublayer=SUBLAYERS[name], release=("none", 0)), store)
    return [name for name in reads if there[name]]


def fetch_stored(spark: SparkSession, root: str, store: str, dataset: str, ttl_seconds: int = WEEK) -> DataFrame:
    """A dataset of the snapshot store; all feeds are written first if it has no fresh snapshot."""
    try:
        found = read_snapshot(spark, store, sublayer=SUBLAYERS[dataset])
        stale = fresh(found, ttl_seconds).isEmpty()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        stale = True
    if stale:
        ingest(spark, root, store)
    return read_snapshot(spark, store, sublayer=SUBLAYERS[dataset]).drop(*PARTITIONS, "ingested_at")
