"""Driver-side argument checks and small builders (no data passes through here)."""

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from macroloom.errors import NoDataError
from macroloom.schema import RELEASE_MONTHS

# Footer label of the exchange feed for each unit basis.
RATE_LABEL_BY_BASIS = {"SDR": "SDR1 = US$", "USD": "U.S.$1.00 = SDR"}


def check_release(release):
    """Normalise a ``(month, year)`` argument; TypeError when it cannot be one."""
    if not isinstance(release, tuple) or len(release) != 2:
        raise TypeError("A release is a tuple of month ('April' or 'October') and year")
    month, year = release
    if not isinstance(month, str) or month.strip().capitalize() not in RELEASE_MONTHS:
        raise TypeError("The month of a release is `April` or `October`")
    try:
        year = int(year)
    except ValueError as exc:
        raise TypeError("The year of a release is an integer") from exc
    return month.strip().capitalize(), year


def requested_release(release, purpose="data"):
    """As ``check_release`` but reported as missing data, which is what callers catch."""
    try:
        return check_release(release)
    except Exception as exc:
        raise NoDataError(f"Could not fetch {purpose} for version: {release!r}. {exc}") from exc


def expected_latest_release(today=None):
    """Newest release the calendar promises, on the UTC date unless ``today`` is given."""
    today = today or _dt.datetime.now(tz=_dt.timezone.utc).date()
    if today.month < 4:
        return "October", today.year - 1
    return ("April" if today.month < 10 else "October"), today.year


def release_sort_key(release):
    month, year = release
    return year, RELEASE_MONTHS.index(month)


def rate_label(unit_basis: str) -> str:
    if unit_basis not in RATE_LABEL_BY_BASIS:
        raise ValueError("unit_basis must be either 'SDR' or 'USD'")
    return RATE_LABEL_BY_BASIS[unit_basis]


def check_month_served(month, latest):
    """ValueError when a (year, month) lies after the latest one published."""
    if tuple(month) > tuple(latest):
        raise ValueError(
            f"SDR data unavailable for: ({month[0]}, {month[1]}).\n"
            f"Latest available: ({latest[0]}, {latest[1]})"
        )


def archive_paths(month: Column, year: Column) -> Column:
    """Paths a bulk archive may have been published under, the likelier shape of its era first."""
    folder = F.concat(F.lit("/"), year.cast("string"), F.lit("/"))
    name = F.concat(
        F.lit("weo"), F.when(month == "April", "apr").otherwise("oct"), year.cast("string"), F.lit("-sdmxdata.zip")
    )
    plain = F.concat(folder, name)
    by_month = F.concat(folder, F.lower(month), F.lit("/"), name)
    by_number = F.concat(folder, F.when(month == "April", "01/").otherwise("02/"), name)
    return F.when(year >= 2024, F.array(by_month, plain, by_number)).otherwise(F.array(plain, by_month, by_number))
