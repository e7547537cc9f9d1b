"""Scheduled trips: bronze projection, silver cleaning and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import clock, values
from delaylake.operators.dimensions import keep_smallest
from delaylake.sources.files import require_columns
from delaylake.sources.schemas import TRIP_COLUMNS

# Share of NAS delay caused by weather, per year, and elsewhere.
WEATHER_SHARE_OF_NAS = {
    2009: 0.657,
    2010: 0.636,
    2011: 0.633,
    2012: 0.588,
    2013: 0.583,
}
DEFAULT_WEATHER_SHARE = 0.58


def bronze_projection(raw: DataFrame) -> DataFrame:
    """Pick and cast the trip columns; text that is no number becomes null."""
    require_columns(raw, TRIP_COLUMNS)
    ints = {
        "OP_CARRIER_AIRLINE_ID": "OP_CARRIER_AIRLINE_ID",
        "OP_CARRIER_FL_NUM": "FL_NUM",
        "ORIGIN_AIRPORT_ID": "origin_airport_id",
        "DEST_AIRPORT_ID": "dest_airport_id",
        "CRS_DEP_TIME": "CRS_DEP_TIME",
        "CANCELLED": "CANCELLED",
        "DIVERTED": "DIVERTED",
    }
    doubles = ["CRS_ELAPSED_TIME", "ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY"]
    return raw.select(
        F.col("FL_DATE").try_cast("date").alias("FL_DATE"),
        *(values.whole_number(F.col(c)).alias(name) for c, name in ints.items()),
        *(values.real_number(F.col(c)).alias(c) for c in doubles),
    )


def with_offsets(trips: DataFrame, offsets: DataFrame) -> DataFrame:
    """Look the hour offset up twice, as origin and as destination."""
    for role in ("origin", "dest"):
        side = offsets.select(
            F.col("airport_id").alias(f"{role}_airport_id"),
            F.col("tz_hour").alias(f"{role}_tz"),
        )
        trips = trips.join(side, f"{role}_airport_id", "left")
    return trips


def bronze_trips(raw: DataFrame, offsets: DataFrame) -> DataFrame:
    """Typed trips with UTC departure and arrival.

    An unknown origin offset leaves both UTC times null. A missing elapsed
    time counts as zero minutes.
    """
    placed = with_offsets(bronze_projection(raw), offsets)
    timed = placed.withColumns(
        {
            "CRS_DEP_TS_LOCAL": clock.local_timestamp(
                F.col("FL_DATE"), F.col("CRS_DEP_TIME")
            ),
            "elapsed_min": F.coalesce(F.col("CRS_ELAPSED_TIME").try_cast("int"), F.lit(0)),
        }
    )
    departed = timed.withColumn(
        "dep_ts_utc", clock.local_to_utc(F.col("CRS_DEP_TS_LOCAL"), F.col("origin_tz"))
    )
    return departed.select(
        *TRIP_ORDER,
        clock.add_minutes(F.col("dep_ts_utc"), F.col("elapsed_min")).alias("arr_ts_utc"),
        clock.year_column(F.col("FL_DATE")),
        clock.month_column(F.col("FL_DATE")),
    )


TRIP_ORDER = [
    "FL_DATE",
    "OP_CARRIER_AIRLINE_ID",
    "FL_NUM",
    "origin_airport_id",
    "dest_airport_id",
    "CRS_DEP_TIME",
    "CRS_ELAPSED_TIME",
    "ARR_DELAY_NEW",
    "CANCELLED",
    "DIVERTED",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "origin_tz",
    "dest_tz",
    "CRS_DEP_TS_LOCAL",
    "elapsed_min",
    "dep_ts_utc",
]


# Columns of the silver trips, in order.
SILVER_COLUMNS = [
    "OP_CARRIER_AIRLINE_ID",
    "CRS_DEP_TIME",
    "ARR_DELAY_NEW",
    "origin_airport_id",
    "dest_airport_id",
    "FL_DATE",
    "FL_NUM",
    "dep_ts_utc",
    "arr_ts_utc",
    "year",
    "month",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "NAS_WEATHER_DELAY",
    "alpha_nas",
    "total_weather_delay",
    "ARR_DELAY_NASW",
]


def clean_trips(bronze: DataFrame) -> DataFrame:
    """Drop cancelled and diverted trips and split NAS delay by its weather share."""
    shares = F.create_map(
        *(F.lit(v) for pair in WEATHER_SHARE_OF_NAS.items() for v in pair)
    )
    alpha = F.coalesce(
        F.element_at(shares, F.col("year").cast("int")), F.lit(DEFAULT_WEATHER_SHARE)
    )
    flown = bronze.filter(
        (F.coalesce(F.col("CANCELLED"), F.lit(0)) == 0)
        & (F.coalesce(F.col("DIVERTED"), F.lit(0)) == 0)
    )
    filled = flown.withColumns(
        {
            "WEATHER_DELAY": F.coalesce(F.col("WEATHER_DELAY"), F.lit(0.0)),
            "NAS_DELAY": F.coalesce(F.col("NAS_DELAY"), F.lit(0.0)),
            "alpha_nas": alpha,
        }
    )
    weather_part = F.col("alpha_nas") * F.col("NAS_DELAY")
    other_part = (F.lit(1.0) - F.col("alpha_nas")) * F.col("NAS_DELAY")
    return filled.withColumns(
        {
            "NAS_WEATHER_DELAY": weather_part,
            "total_weather_delay": F.col("WEATHER_DELAY") + weather_part,
            "ARR_DELAY_NASW": F.col("ARR_DELAY_NEW") - other_part,
        }
    ).select(*SILVER_COLUMNS)


def served_airports(trips: DataFrame) -> DataFrame:
    """Distinct origins and destinations, from one scan."""
    ends = F.array("origin_airport_id", "dest_airport_id")
    return trips.select(F.explode(ends).alias("airport_id")).distinct()


def with_trip_key(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "trip_key",
        values.trip_key(
            F.col("OP_CARRIER_AIRLINE_ID"),
            F.col("FL_NUM"),
            F.col("FL_DATE"),
            F.col("origin_airport_id"),
            F.col("dest_airport_id"),
        ),
    )


#: Parts that the copies of one trip are dealt to at most, before they meet.
COPY_PARTS = 16


def unique_trips(trips: DataFrame) -> DataFrame:
    """One row per ``trip_key``, the smallest of its copies.

    The choice sorts the rows of a task. So they are dealt first: a task then
    sorts what a shuffle partition holds, however large the splits of the files.
    Copies go by key and task they come from, and collapse before they meet.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(COPY_PARTS))
    dealt = trips.withColumn("_dealt_by", part).repartition("trip_key", "_dealt_by")
    return keep_smallest(keep_smallest(dealt, ["trip_key", "_dealt_by"]).drop("_dealt_by"), ["trip_key"])
