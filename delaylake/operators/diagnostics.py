"""Diagnostics of the targets table, its features and its sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake.operators.quality import long_form
from delaylake.operators.timeline import ARRAY_NAMES, POINT_FIELDS
from delaylake.operators.trips import served_airports

# Summaries shown in the feature statistics.
KEY_FEATURES = [
    f"{end}_{name}"
    for end in ("o", "d")
    for name in ("vis_avg", "temp_avg", "wind_avg", "precip_sum")
]


def array_population(targets: DataFrame) -> DataFrame:
    """Per timeline: size statistics, empty arrays and rows with both filled."""
    sizes = targets.select(*(F.size(a).alias(a) for a in ARRAY_NAMES.values()))
    sums, rows = [], []
    for a in ARRAY_NAMES.values():
        stats = {
            "filled": F.count(a),
            "mean_size": F.avg(a),
            "std_size": F.stddev_samp(a),
            "min_size": F.min(a),
            "max_size": F.max(a),
            "empty": F.count_if(F.col(a) == 0),
        }
        sums += [c.alias(f"{a}_{n}") for n, c in stats.items()]
        rows.append(
            {
                "timeline": F.lit(a),
                **{n: F.col(f"{a}_{n}") for n in stats},
                "both_filled": F.col("both_filled"),
                "total": F.col("total"),
                "empty_pct": F.try_divide(F.col(f"{a}_empty") * F.lit(100.0), F.col("total")),
            }
        )
    both = F.count_if((F.col("Wo") > 0) & (F.col("Wd") > 0)).alias("both_filled")
    return long_form(sizes.agg(*sums, both, F.count(F.lit(1)).alias("total")), rows)


def array_size_histogram(targets: DataFrame) -> DataFrame:
    """``(timeline, size, count)`` of both timelines, from one scan."""
    pairs = F.array(
        *(
            F.struct(F.lit(a).alias("timeline"), F.size(a).alias("size"))
            for a in ARRAY_NAMES.values()
        )
    )
    return (
        targets.select(F.inline(pairs)).groupBy("timeline", "size").count()
    ).orderBy("timeline", "size")


def struct_null_rates(targets: DataFrame) -> DataFrame:
    """Nulls per field of the newest point, and points with no reading at all.

    Rows count when either timeline is filled; the row ``all fields`` tells how
    many newest points hold nothing. One aggregation for both timelines.
    """
    rows_with_any = targets.filter((F.size("Wo") > 0) | (F.size("Wd") > 0))
    sums, rows = [F.count(F.lit(1)).alias("total")], []
    for prefix, array in ARRAY_NAMES.items():
        filled = F.size(array) > 0
        newest = F.get(array, F.lit(0))
        nulls: dict[str, Column] = {
            f"{prefix}_{n}": newest.getField(f"{prefix}_{n}").isNull() for n in POINT_FIELDS
        }
        nulls["all fields"] = reduce(and_, nulls.values())
        for i, (name, test) in enumerate(nulls.items()):
            sums.append(F.count_if(filled & test).alias(f"{prefix}{i}"))
            n = F.col(f"{prefix}{i}")
            rows.append(
                {
                    "timeline": F.lit(array),
                    "field": F.lit(name),
                    "nulls": n,
                    "total": F.col("total"),
                    "null_pct": F.try_divide(n * F.lit(100.0), F.col("total")),
                }
            )
    return long_form(rows_with_any.agg(*sums), rows).orderBy(
        "timeline", F.desc("nulls"), "field"
    )


def newest_points(targets: DataFrame, timeline: str, n: int = 5) -> DataFrame:
    """Newest points of the first ``n`` trips by key, for inspection."""
    return (
        targets.filter(F.size(timeline) > 0)
        .select("F.trip_key", F.get(timeline, F.lit(0)).alias("point"))
        .orderBy("trip_key")
        .limit(n)
    )


def feature_variances(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, variance)``, largest first; null (under two rows) counts as 0."""
    sums = [F.coalesce(F.var_samp(n), F.lit(0.0)).alias(n) for n in names]
    rows = [{"feature": F.lit(n), "variance": F.col(n)} for n in names]
    return long_form(features.agg(*sums), rows).orderBy(F.desc("variance"), "feature")


def variance_extremes(variances: DataFrame, n: int = 20, digits: int = 6) -> DataFrame:
    """Top and bottom ``n`` features, from one evaluation of the variances.

    Features rank by the rounded variance, then by name: equal variances differ
    in their last bits with the order of summation. The window has no partition: its rows are the features, a few hundred.
    """
    ranking = Window.orderBy(F.desc(F.round("variance", digits)), "feature")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = variances.withColumns(
        {
            "place": F.row_number().over(ranking),
            "features": F.count(F.lit(1)).over(everything.orderBy(F.lit(1))),
        }
    )
    ends = F.array_compact(
        F.array(
            F.when(F.col("place") <= n, "top"),
            F.when(F.col("place") > F.col("features") - n, "bottom"),
        )
    )
    return ranked.select("feature", "variance", F.explode(ends).alias("end"))


def variance_counts(variances: DataFrame) -> DataFrame:
    return variances.agg(
        F.count_if(F.col("variance") == 0).alias("zero_variance"),
        F.count_if(F.col("variance") > 0).alias("nonzero_variance"),
        F.count(F.lit(1)).alias("features"),
    )


def feature_statistics(
    features: DataFrame, names: Sequence[str] = tuple(KEY_FEATURES)
) -> DataFrame:
    """``(feature, mean, std, min, max)`` of the summaries that exist."""
    present = [n for n in names if n in features.columns]
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    sums = [f(n).alias(f"{s}_{n}") for n in present for s, f in stats.items()]
    rows = [
        {
            "feature": F.lit(n),
            **{s: F.coalesce(F.col(f"{s}_{n}"), F.lit(0.0)) for s in stats},
        }
        for n in present
    ]
    return long_form(features.agg(*sums), rows)


def feature_sample(features: DataFrame, n: int = 10) -> DataFrame:
    shown = [c for c in KEY_FEATURES if c in features.columns]
    return features.select("trip_key", "label", *shown).orderBy("trip_key").limit(n)


def airport_roles(observations: DataFrame, trips: DataFrame) -> DataFrame:
    """One row per airport with flags: has weather, is an origin, is a destination.

    Both sources are reduced to distinct airports on the map side, so the
    shuffles carry airports, not rows.
    """
    roles = F.array(
        F.struct(
            F.col("origin_airport_id").alias("airport_id"),
            F.lit(True).alias("is_origin"),
            F.lit(False).alias("is_dest"),
        ),
        F.struct(
            F.col("dest_airport_id").alias("airport_id"),
            F.lit(False).alias("is_origin"),
            F.lit(True).alias("is_dest"),
        ),
    )
    from_trips = trips.select(F.inline(roles)).withColumn("has_weather", F.lit(False))
    from_weather = observations.select(
        "airport_id",
        F.lit(False).alias("is_origin"),
        F.lit(False).alias("is_dest"),
        F.lit(True).alias("has_weather"),
    )
    return (
        from_trips.unionByName(from_weather)
        .groupBy("airport_id")
        .agg(
            F.max("is_origin").alias("is_origin"),
            F.max("is_dest").alias("is_dest"),
            F.max("has_weather").alias("has_weather"),
        )
    )


def coverage_counts(observations: DataFrame, trips: DataFrame) -> DataFrame:
    """One row: airports per source, in both and missing on either side."""
    served = F.col("is_origin") | F.col("is_dest")
    weather = F.col("has_weather")
    return airport_roles(observations, trips).agg(
        F.count_if(weather).alias("weather_airports"),
        F.count_if("is_origin").alias("origin_airports"),
        F.count_if("is_dest").alias("dest_airports"),
        F.count_if(served).alias("trip_airports"),
        F.count_if(served & weather & F.col("airport_id").isNotNull()).alias("in_both"),
        F.count_if(served & (~weather | F.col("airport_id").isNull())).alias("trips_only"),
        F.count_if(~served & weather).alias("weather_only"),
    )


def airports_without_weather(observations: DataFrame, trips: DataFrame) -> DataFrame:
    weather = observations.select("airport_id").distinct()
    return served_airports(trips).join(weather, "airport_id", "left_anti")


def airports_without_trips(observations: DataFrame, trips: DataFrame) -> DataFrame:
    weather = observations.select("airport_id").distinct()
    return weather.join(served_airports(trips), "airport_id", "left_anti")


def temporal_coverage(observations: DataFrame, trips: DataFrame) -> DataFrame:
    """``(source, min_ts, max_ts, rows)`` of weather and trips."""

    def span(df: DataFrame, source: str, ts: str) -> DataFrame:
        return df.agg(
            F.min(ts).alias("min_ts"),
            F.max(ts).alias("max_ts"),
            F.count(F.lit(1)).alias("rows"),
        ).select(F.lit(source).alias("source"), "min_ts", "max_ts", "rows")

    return span(observations, "weather", "obs_utc").unionByName(
        span(trips, "trips", "dep_ts_utc")
    )


def observations_per_airport(observations: DataFrame, n: int | None = 20) -> DataFrame:
    """``(airport_id, obs_count)``, busiest first."""
    counts = observations.groupBy("airport_id").agg(F.count(F.lit(1)).alias("obs_count"))
    ordered = counts.orderBy(F.desc("obs_count"), "airport_id")
    return ordered if n is None else ordered.limit(n)
