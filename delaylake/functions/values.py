"""Tolerant casts, station ids, entity keys, unit fallbacks and hash sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def real_number(c: Column) -> Column:
    """Double, or null for text that is no number (``M``, blank).

    Text without a digit (or the ``n`` of ``NaN`` and ``inf``) is sorted out
    first: a failing cast raises and catches an exception for every value.
    """
    return F.when(c.rlike("[0-9nN]"), c.try_cast("double"))


def whole_number(c: Column) -> Column:
    """Int through double, so that ``0.00`` reads as 0."""
    return real_number(c).try_cast("int")


def station_id(c: Column) -> Column:
    """One spelling per station: trimmed, upper case, digits padded to five."""
    text = F.upper(F.trim(c.cast("string")))
    return F.when(text.rlike(r"^[0-9]{1,4}$"), F.lpad(text, 5, "0")).otherwise(text)


def trip_key(
    carrier: Column, number: Column, date: Column, origin: Column, dest: Column
) -> Column:
    """``carrier-0number-yyyy-MM-dd-origin-dest``; null parts are left out.

    Numbers are padded to four digits, longer ones stay whole.
    """
    digits = number.cast("string")
    return F.concat_ws(
        "-",
        carrier.cast("string"),
        F.when(F.length(digits) >= 4, digits).otherwise(F.lpad(digits, 4, "0")),
        F.date_format(date, "yyyy-MM-dd"),
        origin.cast("string"),
        dest.cast("string"),
    )


def celsius(celsius_value: Column, fahrenheit_value: Column) -> Column:
    """The Celsius reading, else the converted Fahrenheit reading."""
    return F.coalesce(celsius_value, (fahrenheit_value - 32.0) * (5.0 / 9.0))


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on key and seed only.

    Unlike ``sample(seed)`` the draw for a row is the same under any
    partitioning, after a retry and on a recomputed partition.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


#: Bits of :func:`draw_number`: fifteen hexadecimal digits.
DRAW_BITS = 60


def draw_number(key: Column, seed: int) -> Column:
    """The digest of :func:`unit_hash` as a whole number of 60 bits, for draws of an exact size."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
