"""Flat model features from the targets table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import clock, values
from delaylake.operators.targets import target_slice

# Measures and per-end summaries used as features.
WEATHER_VARIABLES = [
    "vis",
    "tempC",
    "dewC",
    "rh",
    "windKt",
    "windDir",
    "altim",
    "slp",
    "stnp",
    "precip",
]
SUMMARIES = [
    "vis_avg",
    "temp_avg",
    "wind_avg",
    "precip_sum",
    "has_precip",
    "has_heavy_precip",
    "has_low_vis",
    "has_ts",
    "has_sn",
    "has_fg",
]
WEATHER_CODES = {"has_ts": "TS", "has_sn": "SN", "has_fg": "FG"}
HEAVY_PRECIP = 2.0
LOW_VISIBILITY = 1.0
# Columns that a training row must have.
REQUIRED = [
    "label",
    "carrier_id",
    "origin_id",
    "dest_id",
    "flnum",
    "year",
    "month",
    "dep_minutes",
]


# Columns of :func:`flat_features` besides the timelines.
FLAT_COLUMNS = ["trip_key", "ds", "th", *REQUIRED, "crs_dep_time"]


@dataclass(frozen=True)
class FeatureSettings:
    label_column: str = "is_pos"
    test_fraction: float = 0.2
    seed: int = 42


def hour_feature_names(prefix: str, hours: int) -> list[str]:
    return [
        f"{prefix}_h{h}_{v}{suffix}"
        for h in range(hours)
        for v in WEATHER_VARIABLES
        for suffix in ("", "_isna")
    ]


def weather_feature_names(origin_hours: int, dest_hours: int) -> list[str]:
    """Names of the weather features, hourly ones first."""
    ends = {"o": origin_hours, "d": dest_hours}
    hourly = [n for p, hours in ends.items() for n in hour_feature_names(p, hours)]
    summed = [f"{p}_{s}" for p, hours in ends.items() if hours > 0 for s in SUMMARIES]
    return hourly + summed


def flat_features(
    targets: DataFrame, settings: FeatureSettings = FeatureSettings()
) -> DataFrame:
    """Label, ids and departure minute; rows missing one of them drop out.

    The timelines stay in the row and are not part of the completeness test.
    """
    flat = targets.select(
        "trip_key",
        "ds",
        "th",
        F.col(settings.label_column).cast("double").alias("label"),
        F.col("F.carrier").alias("carrier_id"),
        F.col("F.origin_airport_id").alias("origin_id"),
        F.col("F.dest_airport_id").alias("dest_id"),
        F.col("F.flnum").alias("flnum"),
        F.col("F.crs_dep_scheduled_hhmm").alias("crs_dep_time"),
        "year",
        F.col("month").cast("int").alias("month"),
        "Wo",
        "Wd",
        clock.minutes_of_day(F.col("F.crs_dep_scheduled_hhmm")).alias("dep_minutes"),
    )
    return flat.na.drop("any", subset=REQUIRED)


def _hour_features(prefix: str, array: str, hours: int) -> list[str]:
    """SQL of the readings of one end, hour by hour."""
    hourly = []
    for h in range(hours):
        for v in WEATHER_VARIABLES:
            reading, name = f"get({array}, {h}).{prefix}_{v}", f"{prefix}_h{h}_{v}"
            hourly.append(f"coalesce({reading}, 0D) as {name}")
            hourly.append(f"cast({reading} is null as double) as {name}_isna")
    return hourly


def _window_features(prefix: str, array: str, hours: int, ignore_missing: bool = False) -> list[str]:
    """SQL of the summaries of one end over some hours."""

    window = f"slice({array}, 1, {hours})"

    def total(name: str) -> str:
        return f"aggregate({window}, 0D, (s, p) -> s + coalesce(p.{prefix}_{name}, 0D))"

    def average(name: str) -> str:
        if not ignore_missing:
            return f"{total(name)} / {hours}D"
        seen = f"size(filter({window}, p -> p.{prefix}_{name} is not null))"
        return f"coalesce({total(name)} / nullif({seen}, 0), 0D)"

    def any_of(name: str, test: str) -> str:
        found = f"exists({window}, p -> coalesce(p.{prefix}_{name} {test}, false))"
        return f"cast(coalesce({found}, false) as double)"

    summaries = {
        "vis_avg": average("vis"),
        "temp_avg": average("tempC"),
        "wind_avg": average("windKt"),
        "precip_sum": total("precip"),
        "has_precip": any_of("precip", "> 0"),
        "has_heavy_precip": any_of("precip", f">= {HEAVY_PRECIP}D"),
        "has_low_vis": any_of("vis", f"< {LOW_VISIBILITY}D"),
        **{n: any_of("wxType", f"like '%{code}%'") for n, code in WEATHER_CODES.items()},
    }
    return [f"{e} as {prefix}_{n}" for n, e in summaries.items()]


def _end_features(prefix: str, array: str, hours: int, ignore_missing: bool) -> list[str]:
    """SQL of the features of one end."""
    return _hour_features(prefix, array, hours) + _window_features(prefix, array, hours, ignore_missing)


def weather_features(
    flat: DataFrame, origin_hours: int, dest_hours: int, ignore_missing: bool = False
) -> DataFrame:
    """Add the hourly readings and the per-end summaries in one projection.

    A missing reading counts as 0 and is flagged in its ``_isna`` column; the
    averages divide by the window length, or by the readings seen with
    ``ignore_missing`` (0 without any).
    """
    added = []
    if origin_hours > 0:
        added += _end_features("o", "Wo", origin_hours, ignore_missing)
    if dest_hours > 0:
        added += _end_features("d", "Wd", dest_hours, ignore_missing)
    return flat.selectExpr("*", *added)


Window = tuple[int, int]


def several_windows(flat: DataFrame, windows: Sequence[Window]) -> DataFrame:
    """The features of several windows (hours at the origin, at the destination) in one row.

    They are arrays: ``o`` and ``d`` of the readings hour by hour, which windows
    share, and ``o3`` of the summaries over three hours at the origin.
    :func:`one_window` puts those of a window together.
    """
    added = []
    for i, (prefix, array) in enumerate((("o", "Wo"), ("d", "Wd"))):
        lengths = sorted({w[i] for w in windows if w[i] > 0})
        parts = {f"{prefix}{h}": _window_features(prefix, array, h) for h in lengths}
        if lengths:
            parts[prefix] = _hour_features(prefix, array, lengths[-1])
        for name, sql in parts.items():
            values_only = ", ".join(e.rsplit(" as ", 1)[0] for e in sql)
            added.append(f"array({values_only}) as {name}")
    return flat.selectExpr("*", *added).drop("Wo", "Wd")


def one_window(wide: DataFrame, origin_hours: int, dest_hours: int) -> DataFrame:
    """Of :func:`several_windows`: ``weather``, an array in the order of :func:`weather_feature_names`."""
    ends = {p: hours for p, hours in (("o", origin_hours), ("d", dest_hours)) if hours > 0}
    readings = [F.slice(p, 1, len(hour_feature_names(p, hours))) for p, hours in ends.items()]
    summaries = [F.col(f"{p}{hours}") for p, hours in ends.items()]
    weather = F.concat(*readings, *summaries) if ends else F.expr("cast(array() as array<double>)")
    return wide.select(*(c for c in wide.columns if c in FLAT_COLUMNS), weather.alias("weather"))


def hash_split(
    df: DataFrame, key: str, test_fraction: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows, the same under any partitioning."""
    draw = values.unit_hash(F.col(key), seed)
    return df.filter(draw >= test_fraction), df.filter(draw < test_fraction)


def prepare_dataset(
    targets: DataFrame,
    ds: str,
    th: int,
    settings: FeatureSettings = FeatureSettings(),
    origin_hours: int = 0,
    dest_hours: int = 0,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train rows, test rows and weather feature names of one slice."""
    flat = flat_features(target_slice(targets, ds, th), settings)
    full = weather_features(flat, origin_hours, dest_hours).drop("Wo", "Wd")
    return split_dataset(full, settings, origin_hours, dest_hours)


def split_dataset(
    full: DataFrame, settings: FeatureSettings, origin_hours: int, dest_hours: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """What :func:`prepare_dataset` returns, of the features of a slice."""
    train, test = hash_split(full, "trip_key", settings.test_fraction, settings.seed)
    return train, test, weather_feature_names(origin_hours, dest_hours)


def slice_windows(
    targets: DataFrame,
    ds: str,
    th: int,
    settings: FeatureSettings = FeatureSettings(),
    windows: Sequence[Window] = (),
) -> DataFrame:
    """The features of one slice for several windows, to be stored and read by :func:`windowed_dataset`."""
    return several_windows(flat_features(target_slice(targets, ds, th), settings), windows)


def windowed_dataset(
    wide: DataFrame, settings: FeatureSettings, origin_hours: int, dest_hours: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """:func:`prepare_dataset` for one of the windows of :func:`slice_windows`, its weather features in an array."""
    return split_dataset(
        one_window(wide, origin_hours, dest_hours), settings, origin_hours, dest_hours
    )
