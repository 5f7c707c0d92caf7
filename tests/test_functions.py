import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from macroloom.errors import NoDataError
from macroloom.functions import dates, labels, numbers, text


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


def test_actual_year(spark):
    got = apply(spark, dates.actual_year, ["FY2023/24", "2024", "garbage", "N/A", "n/a", None, "20245", "FY2023"])
    assert got == [2023, 2024, None, None, None, None, None, None]


def test_us_date(spark):
    got = apply(spark, dates.us_date, ["9/19/2025", "09/05/2025", "13/1/2025", "N/A", "2025-09-19", None])
    assert got == [dt.datetime(2025, 9, 19), dt.datetime(2025, 9, 5), None, None, None, None]


def test_long_date(spark):
    assert apply(spark, dates.long_date, ["November 30, 2023", "30 Nov"]) == [dt.date(2023, 11, 30), None]


def test_not_applicable(spark):
    assert apply(spark, text.null_if_not_applicable, ["N/A", "n/a", "N/a", "", None, "note"]) == [
        None, None, None, "", None, "note",
    ]


def test_grouped_real(spark):
    got = apply(spark, numbers.grouped_real, ["1.1", "2,123.2", "n/a", "--", "", "NULL", "nan", "1e3", "1d", " 7 ", ".", "e5", "1 2", "-Inf", None])
    assert got == [1.1, 2123.2, None, None, None, None, None, 1000.0, None, 7.0, None, None, None, float("-inf"), None]


def test_whole_numbers(spark):
    assert apply(spark, numbers.whole, [2023.0, None], "double") == [2023, None]
    with pytest.raises(PySparkException, match="Not a whole number"):
        apply(spark, numbers.whole, [2023.5], "double")


def test_digits_only(spark):
    assert apply(spark, numbers.digits_only_real, ["SDR 1,234.5", "-1.5", "abc", None]) == [1234.5, 1.5, None, None]


@pytest.mark.parametrize(
    "exponent, value, scaled, multiplier, name",
    [
        (9.0, 447416000000.0, 447.416, 1000000000, "Billions"),
        (6.0, 2500000.0, 2.5, 1000000, "Millions"),
        (0.0, 3.1, 3.1, 1, "Units"),
        (3.0, 5000.0, 5.0, None, None),
        (None, 7.0, 7.0, None, None),
    ],
)
def test_scale(spark, exponent, value, scaled, multiplier, name):
    df = spark.createDataFrame([(exponent, value)], "e double, v double")
    e, v = F.col("e"), F.col("v")
    assert rows(df.select(numbers.scaled(v, e), numbers.scale_multiplier(e), numbers.scale_name(e))) == [
        (scaled, multiplier, name)
    ]


def test_fingerprint_rounds_half_even(spark):
    got = apply(spark, numbers.fingerprint_value, [0.00005, 0.00015, 1.23456, -0.00001], "double")
    assert got == [0.0, 0.0002, 1.2346, 0.0]


def test_multi_value_and_fields(spark):
    assert apply(spark, text.multi_value, ["F32; F32_CA", "x", None]) == [["F32", "F32_CA"], ["x"], None]
    assert apply(spark, lambda c: text.field(text.fields(c), 2), ["a\tb", "a\tb\tc", "a\tb\t"]) == [None, "c", ""]


def test_aggregate_code(spark):
    assert apply(spark, text.aggregate_code, [1, 406, 1234], "int") == ["G001", "G406", "G1234"]


def test_unit_from_description(spark):
    got = apply(spark, text.unit_from_description, ["Percent change", "Index, 2000=100", "Persons", "percent index", None])
    assert got == ["PT", "IX", None, "PT", None]


def test_version_key_orders_numerically(spark):
    got = apply(spark, dates.version_key, ["9.0.0", "10.0.0", "x.1", None])
    assert got == [[9, 0, 0], [10, 0, 0], [0], [0]]
    assert got[1] > got[0]


def test_vintage_label(spark):
    ids = ["WEO_2025_OCT_VINTAGE", "WEO_2024_APR_VINTAGE", "WEO_2024_JUL_VINTAGE", "WEO"]
    assert apply(spark, dates.vintage_month, ids) == ["October", "April", None, None]
    assert apply(spark, dates.vintage_year, ids) == [2025, 2024, 2024, None]


def test_month_end(spark):
    df = spark.createDataFrame([(1, 2024), (2, 2024), (2, 2023), (4, 2024), (12, 2023)], "m int, y int")
    got = {tuple(r)[0] for r in df.select(dates.month_end_text(F.col("y"), F.col("m"))).collect()}
    assert got == {"2024-1-31", "2024-2-29", "2023-2-28", "2024-4-30", "2023-12-31"}
    for month in (0, 13):
        with pytest.raises(PySparkException):
            spark.range(1).select(dates.month_end(F.lit(2024), F.lit(month))).collect()


def test_expected_release(spark):
    days = [dt.date(2024, 4, 1), dt.date(2024, 10, 1), dt.date(2024, 1, 1)]
    want = [("April", 2024), ("October", 2024), ("October", 2023)]
    got = apply(spark, lambda c: F.struct(*dates.expected_release(c)), days, "date")
    assert [tuple(r) for r in got] == want
    assert [labels.expected_latest_release(d) for d in days] == want


def test_release_month(spark):
    assert apply(spark, dates.release_month, [dt.date(2026, 4, 14), dt.date(2025, 10, 14)], "date") == ["April", "October"]


@pytest.mark.parametrize("given", [(" april ", "2024"), ("April", 2024), (" apRil ", "2024")])
def test_release_argument(given):
    assert labels.check_release(given) == ("April", 2024)
    assert labels.check_release(("october", " 2024 ")) == ("October", 2024)


@pytest.mark.parametrize("given", [("March", 2024), "April 2024", ("April", "words"), (2024, "April"), ("April",)])
def test_bad_release_argument(given):
    with pytest.raises(TypeError):
        labels.check_release(given)
    with pytest.raises(NoDataError):
        labels.requested_release(given)


def test_unit_basis():
    assert labels.rate_label("SDR") == "SDR1 = US$"
    assert labels.rate_label("USD") == "U.S.$1.00 = SDR"
    with pytest.raises(ValueError):
        labels.rate_label("EUR")


def test_future_month():
    labels.check_month_served((2023, 11), (2023, 11))
    with pytest.raises(ValueError, match="2023, 11"):
        labels.check_month_served((2023, 12), (2023, 11))


def test_feed_date(spark):
    patterns = ["M/d/yyyy", "yyyy-M-d"]
    assert apply(spark, lambda c: dates.feed_date(c, patterns), ["01/12/2024", "2023-11-30", None]) == [
        dt.date(2024, 1, 12), dt.date(2023, 11, 30), None,
    ]
    with pytest.raises(PySparkException, match="Unparseable date"):
        apply(spark, lambda c: dates.feed_date(c, patterns), ["soon"])


def test_archive_paths(spark):
    df = spark.createDataFrame([("October", 2020), ("April", 2024)], "month string, year int")
    got = dict(rows(df.select("year", labels.archive_paths(F.col("month"), F.col("year")))))
    assert got[2020] == [
        "/2020/weooct2020-sdmxdata.zip", "/2020/october/weooct2020-sdmxdata.zip", "/2020/02/weooct2020-sdmxdata.zip",
    ]
    assert got[2024] == [
        "/2024/april/weoapr2024-sdmxdata.zip", "/2024/weoapr2024-sdmxdata.zip", "/2024/01/weoapr2024-sdmxdata.zip",
    ]
