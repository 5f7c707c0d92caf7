"""Numeric coercion and scaling. ANSI mode raises on a bad cast, so everything is a try-cast."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from macroloom.schema import MULTIPLIER_BY_EXPONENT, SCALE_NAME_BY_EXPONENT

# Spark's cast also takes suffixes and forms such as "1d" or "0x1p3", which the characters keep out.
IN_NUMBERS, BLANKS = "0123456789eE+-.", " \t\n\r\f\x0b"
INFINITE = [sign + word for sign in ("", "+", "-") for word in ("inf", "infinity")]


def real(value: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    plain = F.translate(value, IN_NUMBERS + BLANKS, "") == ""
    return F.when(plain | F.lower(F.btrim(value, F.lit(BLANKS))).isin(INFINITE), value.try_cast("double"))


def grouped_real(value: Column) -> Column:
    """As ``real`` after removing thousands separators."""
    return real(F.replace(value, F.lit(","), F.lit("")))


def whole(number: Column, to: str = "bigint") -> Column:
    """A double holding a whole number to an integer type; a fraction is an error."""
    return F.when(
        (number == F.floor(number)) | number.isNull(), number.try_cast(to)
    ).otherwise(F.raise_error(F.concat(F.lit("Not a whole number: "), number.cast("string"))))


def digits_only_real(value: Column) -> Column:
    """Keep digits and points only, then coerce. A minus sign is lost, as in the source feed."""
    return real(F.regexp_replace(value, r"[^0-9.]", ""))


def scaled(value: Column, exponent: Column) -> Column:
    """Value in scale: divided by ten to the exponent where the exponent is positive."""
    return F.when(exponent > 0, value / F.pow(F.lit(10.0), exponent)).otherwise(value)


def scale_multiplier(exponent: Column) -> Column:
    """Multiplier of a known exponent, otherwise null."""
    return _by_exponent(exponent, MULTIPLIER_BY_EXPONENT).cast("bigint")


def scale_name(exponent: Column) -> Column:
    """Label of a known exponent, otherwise null."""
    return _by_exponent(exponent, SCALE_NAME_BY_EXPONENT).cast("string")


def _by_exponent(exponent, table):
    chosen = F.lit(None)
    for key, entry in table.items():
        chosen = F.when(exponent == key, F.lit(entry)).otherwise(chosen)
    return chosen


def fingerprint_value(value: Column, places: int = 4) -> Column:
    """Value rounded half-even, the form in which two releases are compared (no negative zero)."""
    return F.bround(value.cast("double"), places) + F.lit(0.0)
