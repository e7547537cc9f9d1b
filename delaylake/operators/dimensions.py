"""Small dimension tables: station and airport mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import values


def keep_smallest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all other columns.

    A plain ``min`` over a struct, so copies collapse before the shuffle and a
    key with very many rows costs its reducer one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *(c for c in rest if c not in order)]
    if not ranked:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest)).select(
        *df.columns
    )


def airport_offsets(mapping: DataFrame) -> DataFrame:
    """``AirportID, TimeZone`` rows to one ``(airport_id, tz_hour)`` per airport."""
    rows = mapping.select(
        values.whole_number(F.col("AirportID")).alias("airport_id"),
        values.whole_number(F.col("TimeZone")).alias("tz_hour"),
    )
    return keep_smallest(rows, ["airport_id"])


def station_offsets(mapping: DataFrame) -> DataFrame:
    """``WBAN, AirportID, TimeZone`` rows to one row per station."""
    rows = mapping.select(
        values.station_id(F.col("WBAN")).alias("WBAN"),
        values.whole_number(F.col("AirportID")).alias("airport_id"),
        values.whole_number(F.col("TimeZone")).alias("tz_hour"),
    )
    return keep_smallest(rows, ["WBAN"])


def station_zones(mapping: DataFrame) -> DataFrame:
    """``WBAN, airport_id, timezone`` rows (IANA zones) to one row per station."""
    rows = mapping.select(
        values.station_id(F.col("WBAN")).alias("WBAN"),
        values.whole_number(F.col("airport_id")).alias("airport_id"),
        F.trim(F.col("timezone")).alias("timezone"),
    )
    return keep_smallest(rows, ["WBAN"])


def airport_zones(mapping: DataFrame) -> DataFrame:
    """One IANA zone per airport."""
    rows = station_zones(mapping).select("airport_id", "timezone")
    return keep_smallest(rows, ["airport_id"])
