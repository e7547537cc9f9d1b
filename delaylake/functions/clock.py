"""Date and time expressions. All arithmetic is on epoch seconds, so only the
parsing of local clock text depends on the session time zone (kept at UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_SECONDS = 3600


def padded_hhmm(hhmm: Column) -> Column:
    """``930 -> '0930'``; text longer than four characters is no clock time: null."""
    text = hhmm.cast("string")
    return F.when(F.length(text) <= 4, F.lpad(text, 4, "0"))


def normalize_date(text: Column) -> Column:
    """Bring ``yyyyMMdd``, ``MM/dd/yyyy`` and ``yyyy/MM/dd`` to ``yyyy-MM-dd``.

    Other text is passed on as it is and left for the parser to reject.
    """
    slashed = F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2")
    slashed = F.regexp_replace(slashed, r"^(\d{4})/(\d{2})/(\d{2})$", "$1-$2-$3")
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return (
        F.when(F.length(text) == 8, dashed)
        .when(F.contains(text, F.lit("/")), slashed)
        .otherwise(text)
    )


def clock_timestamp(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    """Timestamp from calendar parts and HHMM; null when any part is invalid."""
    text = padded_hhmm(hhmm)
    return F.try_make_timestamp(
        year.cast("int"),
        month.cast("int"),
        day.cast("int"),
        F.substring(text, 1, 2).try_cast("int"),
        F.substring(text, 3, 2).try_cast("int"),
        F.lit(0).cast("decimal(16,6)"),
    )


def local_timestamp(date: Column, hhmm: Column, roll_2400: bool = False) -> Column:
    """Local timestamp from a date column and an HHMM number or text.

    With ``roll_2400`` the text ``2400`` is midnight at the end of the day.
    """
    exact = clock_timestamp(F.year(date), F.month(date), F.day(date), hhmm)
    if not roll_2400:
        return exact
    midnight = F.date_add(date, 1).cast("timestamp")
    return F.when(padded_hhmm(hhmm) == "2400", midnight).otherwise(exact)


def text_timestamp(date_text: Column, hhmm: Column) -> Column:
    """Local timestamp from date text in any accepted form and HHMM text."""
    return F.try_to_timestamp(
        F.concat(normalize_date(date_text), F.lit(" "), padded_hhmm(hhmm)),
        F.lit("yyyy-MM-dd HHmm"),
    )


def add_minutes(ts: Column, minutes: Column) -> Column:
    """Shift by whole minutes on the epoch axis; sub-seconds are dropped."""
    return F.timestamp_seconds(F.unix_timestamp(ts) + minutes.cast("long") * 60)


def local_to_utc(ts: Column, offset_hours: Column) -> Column:
    """Local time to UTC by a fixed hour offset; null when the offset is unknown."""
    return add_minutes(ts, -offset_hours * 60)


def zone_to_utc(ts: Column, zone: Column) -> Column:
    """Local time to UTC by IANA zone; an unknown zone counts as UTC."""
    return F.to_utc_timestamp(ts, F.coalesce(zone, F.lit("UTC")))


def hour_start(hour: Column) -> Column:
    return F.timestamp_seconds(hour * HOUR_SECONDS)


def year_column(ts: Column) -> Column:
    return F.year(ts).alias("year")


def month_column(ts: Column) -> Column:
    """Two-digit month text, the partition value used by every table."""
    return F.lpad(F.month(ts).cast("string"), 2, "0").alias("month")


def minutes_of_day(hhmm: Column) -> Column:
    return (hhmm / 100).cast("int") * 60 + hhmm % 100
