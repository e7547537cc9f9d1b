"""Station observations: bronze projection and the two silver variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import clock, values
from delaylake.operators.trips import served_airports
from delaylake.sources.files import require_columns
from delaylake.sources.schemas import OBSERVATION_COLUMNS, OBSERVATION_MEASURES


def bronze_observations(raw: DataFrame) -> DataFrame:
    """Typed observations with their naive local time."""
    require_columns(raw, OBSERVATION_COLUMNS)
    timed = raw.select(
        values.station_id(F.col("WBAN")).alias("WBAN"),
        "Date",
        "Time",
        "SkyCondition",
        "WeatherType",
        *(values.real_number(F.col(c)).alias(c) for c in OBSERVATION_MEASURES),
        clock.text_timestamp(F.col("Date").cast("string"), F.col("Time")).alias(
            "obs_local_naive"
        ),
    )
    return timed.select(
        "*",
        clock.year_column(F.col("obs_local_naive")),
        clock.month_column(F.col("obs_local_naive")),
    )


def silver_observations(bronze: DataFrame, stations: DataFrame) -> DataFrame:
    """Observations at known airports, in UTC by hour offset and in Celsius.

    Stations without an airport drop out; a missing offset counts as UTC.
    """
    placed = bronze.join(stations, "WBAN", "inner").filter(F.col("airport_id").isNotNull())
    utc = placed.withColumn(
        "obs_utc",
        clock.local_to_utc(F.col("obs_local_naive"), F.coalesce(F.col("tz_hour"), F.lit(0))),
    )
    return utc.select(
        "airport_id",
        "WBAN",
        "obs_utc",
        "SkyCondition",
        "WeatherType",
        "Visibility",
        values.celsius(F.col("DryBulbCelsius"), F.col("DryBulbFarenheit")).alias("TempC"),
        values.celsius(F.col("DewPointCelsius"), F.col("DewPointFarenheit")).alias(
            "DewPointC"
        ),
        "RelativeHumidity",
        F.col("WindSpeed").alias("WindSpeedKt"),
        "WindDirection",
        "Altimeter",
        "SeaLevelPressure",
        "StationPressure",
        "HourlyPrecip",
        clock.year_column(F.col("obs_utc")),
        clock.month_column(F.col("obs_utc")),
    )


def at_served_airports(
    observations: DataFrame, trips: DataFrame, mapping: DataFrame
) -> DataFrame:
    """Keep observations at mapped airports that some trip starts from or flies to.

    The served airports are looked up in the mapping first, so what is broadcast
    has at most one row per mapped airport and the observations stay in place.
    """
    airports = mapping.select("airport_id").distinct()
    served = airports.join(served_airports(trips), "airport_id", "left_semi")
    return observations.join(F.broadcast(served), "airport_id", "left_semi")


def zoned_observations(bronze: DataFrame, zones: DataFrame, trips: DataFrame) -> DataFrame:
    """Observations at served airports, in UTC by IANA zone.

    Stations of other airports leave the mapping, not the observations; the
    mapping has one row per station and is broadcast.
    """
    served = zones.join(served_airports(trips), "airport_id", "left_semi")
    utc = bronze.join(F.broadcast(served), "WBAN", "inner").withColumn(
        "obs_utc", clock.zone_to_utc(F.col("obs_local_naive"), F.col("timezone"))
    )
    return utc.select(
        "airport_id",
        "timezone",
        "obs_local_naive",
        "obs_utc",
        "WBAN",
        "SkyCondition",
        "WeatherType",
        "Visibility",
        "DryBulbFarenheit",
        "DewPointFarenheit",
        "RelativeHumidity",
        "WindSpeed",
        "WindDirection",
        "Altimeter",
        "SeaLevelPressure",
        "StationPressure",
        "HourlyPrecip",
        clock.year_column(F.col("obs_utc")),
        clock.month_column(F.col("obs_utc")),
    )


def station_join_loss(bronze: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows before and after the station join, the loss in percent and an alarm.

    One pass: counts per station are reduced before the join.
    """
    per_station = bronze.groupBy("WBAN").agg(F.count(F.lit(1)).alias("n"))
    known = stations.select("WBAN", F.lit(True).alias("known"))
    counts = per_station.join(known, "WBAN", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("rows_after"),
    )
    lost = F.col("rows_before") - F.col("rows_after")
    loss = F.try_divide(lost * F.lit(100.0), F.col("rows_before"))
    return counts.select(
        "rows_before",
        "rows_after",
        lost.alias("rows_lost"),
        loss.alias("loss_pct"),
        (loss > LOSS_ALARM_PCT).alias("alarm"),
    )


# Fixed value: share of rows lost in the station join that raises the alarm.
LOSS_ALARM_PCT = 15.0
