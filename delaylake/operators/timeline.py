"""Hourly observations, 13-point weather timelines and the joined trip table.

Instead of exploding each trip into 13 hours, joining and collecting back, the
weather side is laid out once as *strips*: one row per airport and UTC day that
holds a dense array of 36 hourly points (the day and the 12 hours before it).
A trip then needs one equi-join per end, on (airport, day), and a slice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from delaylake.functions import clock
from delaylake.functions.paths import column_or_null
from delaylake.operators.trips import unique_trips
from delaylake.session import broadcast_limit

LOOKBACK_HOURS = 12
POINTS = LOOKBACK_HOURS + 1
DAY_HOURS = 24
STRIP_POINTS = DAY_HOURS + LOOKBACK_HOURS
DEFAULT_TOLERANCE_MIN = 20

# Field names of a weather point and the silver columns they hold.
POINT_FIELDS = {
    "sky": ("SkyCondition", "string"),
    "wxType": ("WeatherType", "string"),
    "vis": ("Visibility", "double"),
    "tempC": ("TempC", "double"),
    "dewC": ("DewPointC", "double"),
    "rh": ("RelativeHumidity", "double"),
    "windKt": ("WindSpeedKt", "double"),
    "windDir": ("WindDirection", "double"),
    "altim": ("Altimeter", "double"),
    "slp": ("SeaLevelPressure", "double"),
    "stnp": ("StationPressure", "double"),
    "precip": ("HourlyPrecip", "double"),
}
ARRAY_NAMES = {"o": "Wo", "d": "Wd"}


def point_type(prefix: str = "") -> str:
    fields = ", ".join(f"{prefix}{n}: {t}" for n, (_, t) in POINT_FIELDS.items())
    return f"struct<{prefix}ts: timestamp, {fields}>"


def empty_point(hour: str) -> str:
    """SQL of a point that knows only its time; ``hour`` counts from the epoch."""
    nothing = ", ".join(f"cast(null as {t}) as {n}" for n, (_, t) in POINT_FIELDS.items())
    return f"struct(timestamp_seconds(({hour}) * {clock.HOUR_SECONDS}) as ts, {nothing})"


def observation_point(df: DataFrame, prefix: str, time_column: str = "obs_utc") -> Column:
    """Weather point of one observation; columns the frame lacks become null."""
    return F.struct(
        column_or_null(df, time_column, "timestamp").alias(f"{prefix}_ts"),
        *(
            column_or_null(df, source, dtype).cast(dtype).alias(f"{prefix}_{name}")
            for name, (source, dtype) in POINT_FIELDS.items()
        ),
    )


def hour_number(ts: str) -> str:
    """SQL: hours since the epoch, the same for any session time zone."""
    return f"cast(floor(unix_timestamp({ts}) / {clock.HOUR_SECONDS}) as bigint)"


def day_number(ts: str) -> str:
    return f"cast(floor({hour_number(ts)} / {DAY_HOURS}) as bigint)"


def complete_trips(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("dep_ts_utc").isNotNull() & F.col("arr_ts_utc").isNotNull())


def trip_bounds(trips: DataFrame, *also: Column) -> DataFrame:
    """One row: 12 hours before the first departure, 12 after the last arrival, and further aggregates."""
    half_day = F.expr(f"interval {LOOKBACK_HOURS} hours")
    return complete_trips(trips).agg(
        (F.min("dep_ts_utc") - half_day).alias("min_ts"),
        (F.max("arr_ts_utc") + half_day).alias("max_ts"),
        *also,
    )


def within_trip_times(observations: DataFrame, trips: DataFrame) -> DataFrame:
    """Observations no trip can refer to are cut at the scan.

    The bounds, one row, are fetched first and enter the plan as literals: they
    reach the file reader and, where the table is split by ``year``, skip whole
    partitions. Without any trip nothing is cut.
    """
    return between_times(observations, *_bound_text(trip_bounds(trips)).first())


def _bound_text(bounds: DataFrame) -> DataFrame:
    text = (F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("min_ts", "max_ts"))
    return bounds.withColumns(dict(zip(("min_ts", "max_ts"), text)))


def between_times(observations: DataFrame, low: str | None, high: str | None) -> DataFrame:
    if low is None or high is None:
        return observations
    kept = observations.filter(
        f"obs_utc between timestamp'{low}' and timestamp'{high}'"
    )
    if "year" in observations.columns:
        kept = kept.filter(f"year between {int(low[:4])} and {int(high[:4])}")
    return kept


def hourly_observations(
    observations: DataFrame, tolerance_min: int = DEFAULT_TOLERANCE_MIN, mode: str = "floor"
) -> DataFrame:
    """One observation per airport and hour: the closest within the tolerance.

    ``mode="floor"`` gives a reading to the hour it falls in, so one late in the
    hour is out of tolerance; ``mode="nearest"`` gives it to the nearest full
    hour, so one at minute 53 counts for the next. Readings out of tolerance go
    before the shuffle. The choice is a ``min`` over a struct: partial
    aggregation leaves one row per airport, hour and map task, and ties fall to
    station and measures, not to arrival order.
    """
    if mode not in ("floor", "nearest"):
        raise ValueError(f"mode is floor or nearest, not {mode}")
    point = observation_point(observations, "p")
    shift = clock.HOUR_SECONDS // 2 if mode == "nearest" else 0
    hour = f"cast(floor((unix_timestamp(obs_utc) + {shift}) / {clock.HOUR_SECONDS}) as bigint)"
    timed = observations.withColumns({"hour": F.expr(hour), "_point": point}).withColumn(
        "off_sec", F.abs(F.unix_timestamp("obs_utc") - F.col("hour") * clock.HOUR_SECONDS)
    )
    payload = [F.col(f"_point.p_{name}").alias(name) for name in POINT_FIELDS]
    near = timed.filter(F.col("off_sec") <= tolerance_min * 60).select(
        "airport_id", "hour", F.struct("off_sec", "obs_utc", "WBAN", *payload).alias("reading")
    )
    best = near.groupBy("airport_id", "hour").agg(F.min("reading").alias("r"))
    return best.select(
        "airport_id",
        "hour",
        clock.hour_start(F.col("hour")).alias("obs_hour"),
        "r.WBAN",
        "r.obs_utc",
        *(f"r.{name}" for name in POINT_FIELDS),
    )


def weather_strips(hourly: DataFrame) -> DataFrame:
    """Dense arrays of 36 hourly points per ``(airport_id, day)``.

    Slot ``i`` is hour ``24 * day - 12 + i``. An afternoon hour belongs to its
    own day and, as lookback, to the next one. At most 36 rows meet in a group
    because the input is unique per airport and hour.
    """
    day, in_day = f"cast(floor(hour / {DAY_HOURS}) as bigint)", f"pmod(hour, {DAY_HOURS})"
    own = f"struct({day} as day, {in_day} + {LOOKBACK_HOURS} as slot)"
    next_day = f"struct({day} + 1 as day, {in_day} - {LOOKBACK_HOURS} as slot)"
    days = (
        f"if({in_day} >= {DAY_HOURS - LOOKBACK_HOURS}, "
        f"array({own}, {next_day}), array({own}))"
    )
    placed = hourly.selectExpr(
        "airport_id",
        f"inline({days})",
        f"struct(obs_hour as ts, {', '.join(POINT_FIELDS)}) as point",
    )
    by_slot = placed.groupBy("airport_id", "day").agg(
        F.expr("map_from_entries(collect_list(struct(cast(slot as int), point))) as points")
    )
    slot_hour = f"day * {DAY_HOURS} - {LOOKBACK_HOURS} + slot"
    dense = (
        f"transform(sequence(0, {STRIP_POINTS - 1}), slot -> "
        f"coalesce(try_element_at(points, slot), {empty_point(slot_hour)}))"
    )
    return by_slot.selectExpr("airport_id", "day", f"{dense} as strip")


TRIP_ENDS = {
    "o": ("origin_airport_id", "dep_ts_utc"),
    "d": ("dest_airport_id", "arr_ts_utc"),
}


def attach_timeline(
    trips: DataFrame, strips: DataFrame, prefix: str, cell: Sequence[str] = ()
) -> DataFrame:
    """Add the 13 points up to the hour of departure (``o``) or arrival (``d``).

    Newest first. An hour without observation is a point with only its time. A
    plain left join: the strips have one row per key, and adaptive execution
    splits the trips of a key that outgrows the others. ``cell`` names columns
    of both sides that belong to the key as well.
    """
    airport, ts = TRIP_ENDS[prefix]
    columns = trips.columns
    keyed = trips.selectExpr(
        *columns,
        f"{airport} as airport_id",
        f"{day_number(ts)} as day",
        f"{hour_number(ts)} as _hour",
    )
    found = keyed.join(strips, [*cell, "airport_id", "day"], "left")
    cut = f"reverse(slice(strip, cast(pmod(_hour, {DAY_HOURS}) + 1 as int), {POINTS}))"
    empty = f"transform(sequence(0, {LOOKBACK_HOURS}), back -> {empty_point('_hour - back')})"
    named = f"array<{point_type(prefix + '_')}>"
    return found.selectExpr(
        *columns, f"cast(coalesce({cut}, {empty}) as {named}) as {ARRAY_NAMES[prefix]}"
    )


#: Bytes of a strip at most, as Spark holds it: 36 points of 13 fields, texts of up to two words.
STRIP_BYTES = STRIP_POINTS * 192
#: Trips that share one cell of :func:`attach_both`.
CELL_TRIPS = 200_000
CELL = ["_day", "_part"]


@dataclass(frozen=True)
class Cells:
    """Into how many parts a departure day is cut: ``usual``, but for the days in ``crowded``."""

    usual: int = 1
    crowded: dict[int, int] = field(default_factory=dict)

    def columns(self) -> dict[str, Column]:
        parts = F.lit(self.usual)
        if self.crowded:
            known = F.create_map(*(F.lit(x) for pair in sorted(self.crowded.items()) for x in pair))
            parts = F.coalesce(F.try_element_at(known, F.expr(day_number("dep_ts_utc"))), parts)
        return {
            "_day": F.expr(day_number("dep_ts_utc")),
            "_part": F.pmod(F.xxhash64("trip_key"), parts),
        }


def trip_cells(trips: DataFrame, cell_trips: int = CELL_TRIPS) -> Cells:
    """Parts per departure day, so that no cell is expected to exceed ``cell_trips``.

    A narrow count per day. Days above four times the mean get a number of
    their own; they are at most a quarter of the days and are what is fetched.
    """
    days = complete_trips(trips).groupBy(F.expr(day_number("dep_ts_utc")).alias("day")).count()
    mean = days.agg(F.avg("count")).first()[0]
    if mean is None:
        return Cells()
    crowded = days.filter(F.col("count") > 4 * mean).collect()
    return Cells(
        math.ceil(4 * mean / cell_trips), {r["day"]: math.ceil(r["count"] / cell_trips) for r in crowded}
    )


def attach_both(
    trips: DataFrame, strips: DataFrame, asked: DataFrame, cells: Cells, also: Sequence[str] = ()
) -> DataFrame:
    """Both timelines without moving a trip that carries one.

    Trips are dealt once, as narrow rows, by cell: departure day and a part of
    it by the hash of their key. Each cell is sent the strips its trips ask for
    at either end, whatever the day of arrival, so both joins find their sides
    dealt alike. ``asked`` has the keys, airports and times of all ``trips`` and
    maybe of more; it is read narrowly. A strip is sent once to each cell that
    asks for it. ``also`` names columns of trips and strips that belong to the
    key of a strip as well.

    The strips of a cell are hashed and its trips stream past them, so no row
    with a timeline is sorted. What a task holds are the strips its cells ask
    for: airports times the few days that one day's trips touch, however many
    the trips.
    """
    placed = trips.withColumns(cells.columns()).repartition(*CELL)
    for prefix, (airport, ts) in TRIP_ENDS.items():
        wanted = (
            complete_trips(asked)
            .withColumns(cells.columns())
            .selectExpr(*CELL, *also, f"{airport} as airport_id", f"{day_number(ts)} as day")
            .distinct()
        )
        sent = wanted.join(strips, [*also, "airport_id", "day"]).repartition(*CELL)
        placed = attach_timeline(placed, sent.hint("shuffle_hash"), prefix, [*CELL, *also])
    return placed.drop(*CELL)


def trip_profile(trips: DataFrame) -> Row:
    """Time bounds as text, and how many bytes the strips of the trips' airports take at most."""
    airports = F.approx_count_distinct("origin_airport_id") + F.approx_count_distinct("dest_airport_id")
    days = F.timestamp_diff("DAY", F.col("min_ts"), F.col("max_ts")) + 2
    bounds = trip_bounds(trips, airports.alias("airports"))
    sized = bounds.withColumn("strip_bytes", F.col("airports") * days * STRIP_BYTES)
    return _bound_text(sized).select("min_ts", "max_ts", "strip_bytes").first()


def with_ends(trips: DataFrame) -> DataFrame:
    """Labeled trips (struct ``F``) with the columns that their timelines are joined by."""
    ends = [c for pair in TRIP_ENDS.values() for c in pair]
    return trips.withColumns({c: F.col(f"F.{c}") for c in [*ends, "trip_key"]})


def attach_stored(trips: DataFrame, strips: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Both timelines of labeled trips (struct ``F``) from strips that were stored.

    How many strips there are decides the form, as in :func:`join_weather`; it
    is read off the stored files. ``also`` as in :func:`attach_both`.
    """
    flat = with_ends(trips)
    if strips.count() * STRIP_BYTES > broadcast_limit(trips.sparkSession):
        placed = attach_both(flat, strips, flat, trip_cells(flat), also)
    else:
        placed = attach_timeline(attach_timeline(flat, strips, "o", also), strips, "d", also)
    return placed.select(*trips.columns, *ARRAY_NAMES.values())


JT_TRIP_COLUMNS = [
    "origin_airport_id",
    "dest_airport_id",
    "dep_ts_utc",
    "arr_ts_utc",
    "ARR_DELAY_NEW",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "NAS_WEATHER_DELAY",
    "OP_CARRIER_AIRLINE_ID",
    "FL_NUM",
    "FL_DATE",
    "CRS_DEP_TIME",
    "trip_key",
    "year",
    "month",
]


def join_weather(
    trips: DataFrame,
    observations: DataFrame,
    tolerance_min: int = DEFAULT_TOLERANCE_MIN,
    deduplicate: bool = True,
    all_trips: DataFrame | None = None,
) -> DataFrame:
    """Trips with both timelines, ``Wo`` and ``Wd``.

    The strips and their shuffle are the same for both ends, so Spark computes
    them once. ``deduplicate=False`` saves a shuffle
    when ``trip_key`` is known to be unique.

    Where the strips may exceed what Spark broadcasts, trips and strips are
    dealt by cells (:func:`attach_both`): a second plain join would move every
    trip with its first timeline.

    ``all_trips`` is the stored table ``trips`` was selected from, if any. The
    time bounds then come from a narrow scan of that table; they may cover more
    than ``trips`` without changing the result.
    """
    profiled = trips if all_trips is None else all_trips
    needed = complete_trips(trips).select(*JT_TRIP_COLUMNS)
    base = unique_trips(needed) if deduplicate else needed
    return attach_observed(base, observations, trips, profiled, tolerance_min)


def attach_observed(
    trips: DataFrame,
    observations: DataFrame,
    asked: DataFrame,
    profiled: DataFrame,
    tolerance_min: int = DEFAULT_TOLERANCE_MIN,
) -> DataFrame:
    """Both timelines of ``trips``, which keep their other columns; see :func:`join_weather`.

    ``asked`` as in :func:`attach_both`; ``profiled`` has the times of all trips and maybe of more.
    """
    profile = trip_profile(profiled)
    near = between_times(observations, profile["min_ts"], profile["max_ts"])
    strips = weather_strips(hourly_observations(near, tolerance_min))
    if (profile["strip_bytes"] or 0) > broadcast_limit(trips.sparkSession):
        return attach_both(trips, strips, asked, trip_cells(profiled))
    return attach_timeline(attach_timeline(trips, strips, "o"), strips, "d")


def label_trips(joined: DataFrame, threshold_min: int) -> DataFrame:
    """Pack the trip into struct ``F`` and label it late (``C = 1``) or not.

    An unknown delay counts as not late. Timelines are kept where the trips have them.
    """
    late = F.when(F.col("ARR_DELAY_NEW") >= threshold_min, 1).otherwise(0)
    packed = F.struct(
        F.col("OP_CARRIER_AIRLINE_ID").alias("carrier"),
        F.col("FL_NUM").alias("flnum"),
        F.col("FL_DATE").alias("date"),
        "origin_airport_id",
        "dest_airport_id",
        F.col("CRS_DEP_TIME").alias("crs_dep_scheduled_hhmm"),
        "dep_ts_utc",
        "arr_ts_utc",
        F.col("ARR_DELAY_NEW").alias("arr_delay_new"),
        F.col("WEATHER_DELAY").alias("weather_delay"),
        F.col("NAS_DELAY").alias("nas_delay"),
        F.col("NAS_WEATHER_DELAY").alias("nas_weather_delay"),
        "trip_key",
    )
    timelines = [w for w in ARRAY_NAMES.values() if w in joined.columns]
    return joined.select(packed.alias("F"), *timelines, late.alias("C"), "year", "month")


def labeled_join(
    trips: DataFrame,
    observations: DataFrame,
    threshold_min: int,
    tolerance_min: int = DEFAULT_TOLERANCE_MIN,
    deduplicate: bool = True,
) -> DataFrame:
    """:func:`join_weather`, then :func:`label_trips`."""
    return label_trips(
        join_weather(trips, observations, tolerance_min, deduplicate), threshold_min
    )
