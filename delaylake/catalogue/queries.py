"""The registered queries: each reads the given tables, whole, and returns flat rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.catalogue import stand_ins
from delaylake.functions import clock, values
from delaylake.operators import (
    diagnostics,
    dimensions,
    features,
    observations,
    quality,
    ratios,
    targets,
    timeline,
    trips,
)
from delaylake.plans import models, stages
from delaylake.sources import files
from delaylake.sources.schemas import TRIP_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REPORT_TH = 60


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)


# ---- shared inputs -------------------------------------------------------


def offsets(spark, sf):
    return stand_ins.offset_mapping(spark, sf)


def bronze_trips(spark, sf):
    return trips.bronze_trips(
        stand_ins.raw_trips(spark, sf), dimensions.airport_offsets(offsets(spark, sf))
    )


def silver_trips(spark, sf):
    return trips.clean_trips(bronze_trips(spark, sf))


def keyed_trips(spark, sf):
    return trips.with_trip_key(silver_trips(spark, sf))


def timed_trips(spark, sf):
    return timeline.complete_trips(keyed_trips(spark, sf))


def unique_timed_trips(spark, sf):
    return trips.unique_trips(timed_trips(spark, sf))


def bronze_observations(spark, sf):
    return observations.bronze_observations(stand_ins.raw_observations(spark, sf))


def silver_observations(spark, sf):
    return observations.silver_observations(
        bronze_observations(spark, sf), dimensions.station_offsets(offsets(spark, sf))
    )


def silver_tables(spark, sf):
    """Silver trips, written and read back as the stages do, and observations.

    Gold plans scan the trips several times and the stored table keeps those
    scans narrow; it is written once per session and input folder. The
    observations are scanned once and stay lazy.
    """
    flown = silver_trips(spark, sf)
    path = _stored_once(spark, "silver_trips", sf, lambda: flown, ["year", "month"])
    return files.read_table(spark, path, flown.schema), silver_observations(spark, sf)


_STORED: dict[tuple[str, str, str], str] = {}


def _stored_once(spark, name, sf, rows, partition_by) -> str:
    key = (spark.sparkContext.applicationId, name, sf)
    if key not in _STORED:
        path = files.shared_folder(spark)
        files.write_table(rows(), path, partition_by)
        _STORED[key] = path
    return _STORED[key]


def joined(spark, sf):
    flown, silver = silver_tables(spark, sf)
    return timeline.join_weather(trips.with_trip_key(flown), silver, all_trips=flown)


def labeled(spark, sf, th=15):
    return timeline.label_trips(joined(spark, sf), th)


def all_targets(spark, sf):
    return stages.gold_targets_direct(*silver_tables(spark, sf))


def packed_targets(spark, sf, thresholds=(REPORT_TH,)):
    """The targets of some thresholds with one row per trip."""
    return stages.gold_targets_direct(*silver_tables(spark, sf), thresholds, packed=True)


def slice_features(spark, sf, origin_hours, dest_hours):
    rows = targets.target_slice(packed_targets(spark, sf))
    return features.weather_features(
        features.flat_features(rows), origin_hours, dest_hours
    ).drop("Wo", "Wd")


# ---- sources and sinks ---------------------------------------------------


@query
def src_csv_roundtrip(spark, sf):
    """Two files with different column order."""
    path, raw = files.shared_folder(spark), stand_ins.raw_trips(spark, sf)
    first = F.col("OP_CARRIER_AIRLINE_ID").cast("int") % 2 == 0
    for part, rows, names in (
        ("a", raw.filter(first), TRIP_COLUMNS),
        ("b", raw.filter(~first), TRIP_COLUMNS[::-1]),
    ):
        rows.select(*names).write.option("header", True).csv(f"{path}/{part}")
    return files.read_delimited(spark, [f"{path}/a", f"{path}/b"], columns=TRIP_COLUMNS)


def _damaged_orders(spark, sf):
    """Orders as lines of text, some with a value too few or too many, or one that is no number or date."""
    path = files.shared_folder(spark)
    stand_ins.damaged_lines(spark, sf).write.text(path)
    return files.read_typed(spark, [path], sep="|", columns=stand_ins.LINE_COLUMNS, tolerance=0.1)


@query
def src_csv_inferred(spark, sf):
    """Types found by inference despite damaged lines, which are set aside."""
    typed, _ = _damaged_orders(spark, sf)
    found = ",".join(t for _, t in typed.dtypes)
    return typed.select(
        F.col("key").cast("bigint").alias("key"),
        rounded("price").alias("price"),
        F.date_format("placed", "yyyy-MM-dd").alias("placed"),
        "priority",
        F.lit(found.replace("bigint", "int")).alias("types"),
    )


@query
def src_csv_quarantine(spark, sf):
    _, bad = _damaged_orders(spark, sf)
    return bad.select(
        "key", "price", "placed", F.col(files.LINE).alias("line"), F.concat_ws(",", "_misfits").alias("misfits")
    )


@query
def src_table_roundtrip(spark, sf):
    path = files.shared_folder(spark)
    clean = files.reject_duplicate_columns(silver_trips(spark, sf))
    files.write_table(clean, path, ["year", "month"])
    back = files.read_table(spark, path, clean.schema)
    return back.select(
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        F.date_format("FL_DATE", "yyyy-MM-dd").alias("FL_DATE"),
        "year",
        "month",
        stamp("dep_ts_utc").alias("dep_ts_utc"),
        rounded("total_weather_delay").alias("total_weather_delay"),
    )


@query
def dim_dedup(spark, sf):
    repeated = stand_ins.repeated_mapping(spark, sf)
    raw = repeated.select("WBAN", "AirportID", "TimeZone")
    zones = repeated.select(
        "WBAN", F.col("zone_airport").alias("airport_id"), F.col("zone").alias("timezone")
    )
    parts = {
        "station_offset": (dimensions.station_offsets(raw), "WBAN", "airport_id", "tz_hour"),
        "airport_offset": (dimensions.airport_offsets(raw), "airport_id", "tz_hour", None),
        "station_zone": (dimensions.station_zones(zones), "WBAN", "airport_id", "timezone"),
        "airport_zone": (dimensions.airport_zones(zones), "airport_id", "timezone", None),
    }
    rows = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("key"),
            F.col(a).cast("string").alias("a"),
            (F.col(b).cast("string") if b else F.lit(None).cast("string")).alias("b"),
        )
        for kind, (df, key, a, b) in parts.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


# ---- scalar operators ----------------------------------------------------


@query
def date_normalize(spark, sf):
    raw = stand_ins.raw_observations(spark, sf)
    return raw.select(F.col("Date").alias("raw_date"), clock.normalize_date(F.col("Date")).alias("day"))


@query
def local_ts(spark, sf):
    typed = trips.bronze_projection(stand_ins.raw_trips(spark, sf))
    day = F.col("FL_DATE")
    return typed.select(
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        stamp(clock.local_timestamp(day, F.col("CRS_DEP_TIME"))).alias("from_date"),
        stamp(
            clock.clock_timestamp(F.year(day), F.month(day), F.day(day), F.col("CRS_DEP_TIME"))
        ).alias("from_parts"),
    )


@query
def local_ts_rolled(spark, sf):
    typed = trips.bronze_projection(stand_ins.raw_trips(spark, sf))
    rolled = clock.local_timestamp(F.col("FL_DATE"), F.col("CRS_DEP_TIME"), roll_2400=True)
    return typed.select("OP_CARRIER_AIRLINE_ID", "FL_NUM", stamp(rolled).alias("dep_local"))


@query
def utc_shift(spark, sf):
    return bronze_trips(spark, sf).select(
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        F.col("origin_tz").cast("double").alias("origin_tz"),
        "elapsed_min",
        stamp("CRS_DEP_TS_LOCAL").alias("dep_local"),
        stamp("dep_ts_utc").alias("dep_utc"),
        stamp("arr_ts_utc").alias("arr_utc"),
    )


@query
def year_month(spark, sf):
    seen = bronze_observations(spark, sf).filter(F.col("obs_local_naive").isNotNull())
    ts = F.col("obs_local_naive")
    return (
        seen.select(clock.year_column(ts), clock.month_column(ts))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def entity_key(spark, sf):
    return keyed_trips(spark, sf).select("trip_key", "FL_NUM")


# ---- bronze and silver ---------------------------------------------------


@query
def role_join_tz(spark, sf):
    typed = trips.bronze_projection(stand_ins.raw_trips(spark, sf))
    placed = trips.with_offsets(typed, dimensions.airport_offsets(offsets(spark, sf)))
    return placed.select(
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        "origin_airport_id",
        "dest_airport_id",
        F.col("origin_tz").cast("double").alias("origin_tz"),
        F.col("dest_tz").cast("double").alias("dest_tz"),
    )


@query
def trips_bronze(spark, sf):
    b = bronze_trips(spark, sf)
    return b.select(
        F.date_format("FL_DATE", "yyyy-MM-dd").alias("FL_DATE"),
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        "origin_airport_id",
        "dest_airport_id",
        "CRS_DEP_TIME",
        "CRS_ELAPSED_TIME",
        "ARR_DELAY_NEW",
        "CANCELLED",
        F.col("DIVERTED").cast("double").alias("DIVERTED"),
        "WEATHER_DELAY",
        "NAS_DELAY",
        stamp("dep_ts_utc").alias("dep_ts_utc"),
        stamp("arr_ts_utc").alias("arr_ts_utc"),
        "year",
        "month",
    )


@query
def trips_silver(spark, sf):
    return silver_trips(spark, sf).select(
        "OP_CARRIER_AIRLINE_ID",
        "FL_NUM",
        F.date_format("FL_DATE", "yyyy-MM-dd").alias("FL_DATE"),
        "origin_airport_id",
        "dest_airport_id",
        "CRS_DEP_TIME",
        stamp("dep_ts_utc").alias("dep_ts_utc"),
        stamp("arr_ts_utc").alias("arr_ts_utc"),
        "year",
        "month",
        "ARR_DELAY_NEW",
        "WEATHER_DELAY",
        "NAS_DELAY",
        "alpha_nas",
        *(
            rounded(c).alias(c)
            for c in ("NAS_WEATHER_DELAY", "total_weather_delay", "ARR_DELAY_NASW")
        ),
    )


@query
def obs_bronze(spark, sf):
    b = bronze_observations(spark, sf)
    return b.select(
        "WBAN",
        "SkyCondition",
        "WeatherType",
        *quality.OBSERVATION_FIELDS[:12],
        "WetBulbFarenheit",
        "WetBulbCelsius",
        stamp("obs_local_naive").alias("obs_local"),
        F.col("year").cast("double").alias("year"),
        "month",
    )


def _silver_rows(df):
    return df.select(
        "airport_id",
        "WBAN",
        stamp("obs_utc").alias("obs_utc"),
        "SkyCondition",
        "WeatherType",
        "Visibility",
        rounded("TempC").alias("TempC"),
        rounded("DewPointC").alias("DewPointC"),
        "RelativeHumidity",
        "WindSpeedKt",
        "WindDirection",
        "Altimeter",
        "SeaLevelPressure",
        "StationPressure",
        "HourlyPrecip",
        F.col("year").cast("double").alias("year"),
        "month",
    )


@query
def obs_silver(spark, sf):
    return _silver_rows(silver_observations(spark, sf))


@query
def obs_utc_iana(spark, sf):
    zones = dimensions.station_zones(stand_ins.zone_mapping(spark, sf))
    zoned = observations.zoned_observations(
        bronze_observations(spark, sf), zones, silver_trips(spark, sf)
    )
    return zoned.select(
        "airport_id",
        "timezone",
        stamp("obs_local_naive").alias("obs_local"),
        stamp("obs_utc").alias("obs_utc"),
        "WBAN",
        "Visibility",
        "DryBulbFarenheit",
        "WindSpeed",
        "HourlyPrecip",
        F.col("year").cast("double").alias("year"),
        "month",
    )


@query
def obs_airport_semi(spark, sf):
    kept = observations.at_served_airports(
        silver_observations(spark, sf),
        bronze_trips(spark, sf),
        dimensions.station_offsets(offsets(spark, sf)),
    )
    return kept.groupBy("airport_id").agg(F.count(F.lit(1)).alias("n"))


@query
def airports_union(spark, sf):
    return trips.served_airports(silver_trips(spark, sf))


@query
def join_loss_report(spark, sf):
    loss = observations.station_join_loss(
        bronze_observations(spark, sf), dimensions.station_offsets(offsets(spark, sf))
    )
    return loss.withColumn("loss_pct", rounded("loss_pct"))


# ---- timelines and the joined table --------------------------------------


@query
def obs_temporal_prune(spark, sf):
    kept = timeline.within_trip_times(silver_observations(spark, sf), silver_trips(spark, sf))
    return kept.select(
        "airport_id", "WBAN", stamp("obs_utc").alias("obs_utc"), "Visibility", "HourlyPrecip"
    )


def _hourly_rows(hourly):
    return hourly.select(
        "airport_id",
        stamp("obs_hour").alias("obs_hour"),
        "WBAN",
        stamp("obs_utc").alias("obs_utc"),
        "sky",
        "wxType",
        *(
            rounded(n).alias(n)
            for n, (_, dtype) in timeline.POINT_FIELDS.items()
            if dtype == "double"
        ),
    )


@query
def hourly_obs(spark, sf):
    return _hourly_rows(timeline.hourly_observations(silver_observations(spark, sf)))


@query
def hourly_obs_nearest(spark, sf):
    silver = silver_observations(spark, sf)
    return _hourly_rows(timeline.hourly_observations(silver, mode="nearest"))


@query
def obs_points(spark, sf):
    silver = silver_observations(spark, sf)
    points = silver.select("airport_id", timeline.observation_point(silver, "o").alias("p"))
    return points.select(
        "airport_id",
        stamp("p.o_ts").alias("o_ts"),
        *(
            (rounded(f"p.o_{n}") if dtype == "double" else F.col(f"p.o_{n}")).alias(f"o_{n}")
            for n, (_, dtype) in timeline.POINT_FIELDS.items()
        ),
    )


def _timeline_rows(spark, sf, prefix):
    flown, silver = silver_tables(spark, sf)
    base = trips.unique_trips(timeline.complete_trips(trips.with_trip_key(flown)))
    numbers = [n for n, (_, dtype) in timeline.POINT_FIELDS.items() if dtype == "double"]
    # A reading is rounded once, not at each of the trips that look at it.
    hourly = timeline.hourly_observations(silver).withColumns({n: rounded(n) for n in numbers})
    with_points = timeline.attach_timeline(base, timeline.weather_strips(hourly), prefix)
    points = with_points.select(
        "trip_key", F.posexplode(timeline.ARRAY_NAMES[prefix]).alias("pos", "p")
    )
    return points.select(
        "trip_key",
        "pos",
        stamp(F.col(f"p.{prefix}_ts")).alias("ts"),
        *(F.col(f"p.{prefix}_{n}").alias(n) for n in timeline.POINT_FIELDS),
    )


@query
def timeline_origin(spark, sf):
    return _timeline_rows(spark, sf, "o")


@query
def timeline_dest(spark, sf):
    return _timeline_rows(spark, sf, "d")


def _end_summary(prefix):
    array = timeline.ARRAY_NAMES[prefix]
    return [
        F.size(array).alias(f"{prefix}_points"),
        F.size(F.array_compact(F.col(f"{array}.{prefix}_vis"))).alias(f"{prefix}_vis_seen"),
        stamp(F.get(array, F.lit(0)).getField(f"{prefix}_ts")).alias(f"{prefix}_first"),
        stamp(F.get(array, F.lit(12)).getField(f"{prefix}_ts")).alias(f"{prefix}_last"),
        F.array_join(F.col(f"{array}.{prefix}_wxType"), ",", "-").alias(f"{prefix}_weather"),
    ]


@query
def jt_base(spark, sf):
    return joined(spark, sf).select(
        "trip_key",
        "origin_airport_id",
        "dest_airport_id",
        stamp("dep_ts_utc").alias("dep_ts_utc"),
        stamp("arr_ts_utc").alias("arr_ts_utc"),
        "ARR_DELAY_NEW",
        rounded("NAS_WEATHER_DELAY").alias("NAS_WEATHER_DELAY"),
        "year",
        "month",
        *_end_summary("o"),
        *_end_summary("d"),
    )


def _labeled_rows(df):
    return df.select(
        "F.trip_key",
        "F.carrier",
        "F.flnum",
        F.date_format("F.date", "yyyy-MM-dd").alias("date"),
        "F.crs_dep_scheduled_hhmm",
        "F.arr_delay_new",
        "F.weather_delay",
        "F.nas_delay",
        rounded("F.nas_weather_delay").alias("nas_weather_delay"),
        "C",
        "year",
        "month",
        *_end_summary("o"),
        *_end_summary("d"),
    )


@query
def jt_labeled(spark, sf):
    flown, silver = silver_tables(spark, sf)
    rows = timeline.labeled_join(trips.with_trip_key(flown), silver, 15)
    return _labeled_rows(rows)


@query
def label_threshold(spark, sf):
    return labeled(spark, sf, REPORT_TH).select("F.trip_key", "F.arr_delay_new", "C")


# ---- targets -------------------------------------------------------------


def measures(spark, sf):
    return targets.unique_measures(timed_trips(spark, sf))


@query
def ratio_metrics(spark, sf):
    m = measures(spark, sf)
    return m.select(
        "trip_key",
        "ARR_DELAY_NEW",
        "WEATHER_DELAY",
        "NAS_DELAY",
        *(rounded(c).alias(c) for c in ("NAS_WEATHER_DELAY", "ARR_NASW", "ratio_adj")),
        "has_meteo",
    )


@query
def class_counts(spark, sf):
    return targets.class_counts(measures(spark, sf))


@query
def balanced_keys(spark, sf):
    return targets.balanced_keys(timed_trips(spark, sf), [REPORT_TH])


@query
def equal_keys(spark, sf):
    return targets.equal_keys(timed_trips(spark, sf))


@query
def keys_all(spark, sf):
    return targets.balanced_keys(timed_trips(spark, sf), seed=targets.GOLD_SEED)


@query
def targets_all(spark, sf):
    return all_targets(spark, sf).select(
        "trip_key",
        "ds",
        "th",
        "is_pos",
        F.col("C").alias("c_ref"),
        F.when(F.col("F.arr_delay_new") >= F.col("th"), 1).otherwise(0).alias("c_th"),
        "year",
        "month",
        *_end_summary("o"),
        *_end_summary("d"),
    )


@query
def target_slice(spark, sf):
    counts = targets.class_balance(packed_targets(spark, sf))
    return counts.select("is_pos", F.col("count").alias("n"))


@query
def target_sample(spark, sf):
    rows = targets.slice_sample(packed_targets(spark, sf))
    return rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def target_reattach(spark, sf):
    keys = targets.balanced_keys(timed_trips(spark, sf), [REPORT_TH], seed=targets.GOLD_SEED)
    attached = targets.target_columns(targets.attach_keys(labeled(spark, sf), keys))
    return attached.select(
        "trip_key", "ds", "th", "is_pos", "C", "F.carrier", *_end_summary("o")
    )


@query
def tau_grid(spark, sf):
    return ratios.tau_counts(ratios.ratio_measures(unique_timed_trips(spark, sf)))


@query
def tau_one(spark, sf):
    return ratios.tau_one_counts(ratios.ratio_measures(unique_timed_trips(spark, sf)))


@query
def ratio_hist(spark, sf):
    return ratios.ratio_histogram(ratios.ratio_measures(unique_timed_trips(spark, sf)))


# ---- quality reports -----------------------------------------------------


@query
def nulls_wide(spark, sf):
    return quality.missing_counts(stand_ins.raw_observations(spark, sf))


@query
def nulls_long(spark, sf):
    return quality.null_rates(bronze_observations(spark, sf))


@query
def obs_check(spark, sf):
    report = quality.observation_check(
        bronze_observations(spark, sf), [*quality.OBSERVATION_FIELDS, "TempC"]
    )
    return report.select(
        "field",
        "present",
        F.col("nulls").cast("double").alias("nulls"),
        rounded("null_pct").alias("null_pct"),
        "total",
        "stations",
    )


@query
def uniques_exact(spark, sf):
    return quality.distinct_counts(
        bronze_trips(spark, sf), quality.BRONZE_TRIP_KEYS, approximate=False
    )


@query
def uniques_approx(spark, sf):
    """Exact counts, and whether each estimate is within three standard errors."""
    silver = silver_trips(spark, sf)
    exact = quality.key_cardinalities(silver, approximate=False)
    near = quality.key_cardinalities(silver).withColumnRenamed("approx_distinct", "estimate")
    gap = F.abs(F.col("estimate") - F.col("approx_distinct"))
    return exact.join(near, "column").select(
        "column",
        F.col("approx_distinct").alias("distinct_values"),
        (gap <= 3 * 0.05 * F.col("approx_distinct")).alias("close"),
    )


@query
def uniques_sketched(spark, sf):
    """Monthly sketches, stored and united, beside exact counts: is each within three standard errors of 0.65 %?"""
    silver, path = silver_trips(spark, sf), files.shared_folder(spark)
    files.write_table(quality.key_sketches(silver, by=["year", "month"]), path)
    found = quality.sketched_cardinalities(files.read_table(spark, path))
    exact = quality.key_cardinalities(silver, approximate=False).withColumnRenamed("approx_distinct", "exact")
    gap = F.abs(F.col("exact") - F.col("approx_distinct"))
    return found.join(exact, "column").select(
        "column",
        "rows",
        F.col("exact").alias("distinct_values"),
        (gap <= 3 * 0.0065 * F.col("exact")).alias("close"),
    )


@query
def delay_quantiles(spark, sf):
    report = quality.delay_quantiles(silver_trips(spark, sf))
    return report.select("column", *(rounded(q).alias(q) for q in quality.QUANTILES))


@query
def delay_rules(spark, sf):
    return quality.delay_rules(silver_trips(spark, sf))


@query
def rule_violations(spark, sf):
    rows = quality.rule_violations(silver_trips(spark, sf))
    return rows.withColumns(
        {
            "FL_DATE": F.date_format("FL_DATE", "yyyy-MM-dd"),
            "total_weather_delay": rounded("total_weather_delay"),
        }
    )


# ---- diagnostics ---------------------------------------------------------


@query
def array_population(spark, sf):
    report = diagnostics.array_population(labeled(spark, sf))
    return report.withColumns(
        {c: rounded(c) for c in ("mean_size", "std_size", "empty_pct")}
    )


@query
def array_size_hist(spark, sf):
    report = diagnostics.array_size_histogram(labeled(spark, sf))
    return report.select("timeline", "size", F.col("count").alias("n"))


@query
def struct_null_rates(spark, sf):
    report = diagnostics.struct_null_rates(labeled(spark, sf))
    return report.withColumn("null_pct", rounded("null_pct"))


@query
def feature_variance(spark, sf):
    names = features.weather_feature_names(3, 2)
    report = diagnostics.feature_variances(slice_features(spark, sf, 3, 2), names)
    return report.withColumn("variance", rounded("variance", 4))


@query
def variance_extremes(spark, sf):
    names = features.weather_feature_names(3, 2)
    report = diagnostics.feature_variances(slice_features(spark, sf, 3, 2), names)
    ends = diagnostics.variance_extremes(report, 20)
    return ends.withColumn("variance", rounded("variance", 4))


@query
def feature_stats(spark, sf):
    report = diagnostics.feature_statistics(slice_features(spark, sf, 3, 2))
    return report.withColumns({c: rounded(c) for c in ("mean", "std", "min", "max")})


@query
def coverage_overlap(spark, sf):
    return diagnostics.coverage_counts(silver_observations(spark, sf), silver_trips(spark, sf))


@query
def coverage_missing(spark, sf):
    silver, flown = silver_observations(spark, sf), silver_trips(spark, sf)
    return (
        diagnostics.airports_without_weather(silver, flown)
        .withColumn("missing", F.lit("weather"))
        .unionByName(
            diagnostics.airports_without_trips(silver, flown).withColumn(
                "missing", F.lit("trips")
            )
        )
    )


@query
def temporal_coverage(spark, sf):
    spans = diagnostics.temporal_coverage(
        silver_observations(spark, sf), silver_trips(spark, sf)
    )
    return spans.select(
        "source", stamp("min_ts").alias("min_ts"), stamp("max_ts").alias("max_ts"), "rows"
    )


@query
def obs_per_station(spark, sf):
    return diagnostics.observations_per_airport(silver_observations(spark, sf))


def _row_counts(reports):
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")
        for name, df in reports.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def report_sets(spark, sf):
    """Rows of every report of the bronze, silver and calibration sets."""
    reports = {
        **stages.bronze_reports(bronze_trips(spark, sf), bronze_observations(spark, sf)),
        **stages.silver_reports(silver_trips(spark, sf)),
        **stages.ratio_reports(unique_timed_trips(spark, sf)),
    }
    return _row_counts(reports)


@query
def diagnostic_set(spark, sf):
    """Rows of every report of the diagnostics of one slice."""
    return _row_counts(
        stages.diagnostic_reports(
            stored_slice(spark, sf),
            silver_trips(spark, sf),
            silver_observations(spark, sf),
            bronze_observations(spark, sf),
            origin_hours=3,
            dest_hours=2,
        )
    )


# ---- features and models -------------------------------------------------


@query
def flat_features(spark, sf):
    flat = features.flat_features(targets.target_slice(packed_targets(spark, sf)))
    return flat.drop("Wo", "Wd")


@query
def wx_features(spark, sf):
    wide = slice_features(spark, sf, 3, 2)
    names = features.weather_feature_names(3, 2)
    return wide.select("trip_key", "label", *(rounded(n).alias(n) for n in names))


@query
def wx_ignore_missing(spark, sf):
    rows = targets.target_slice(packed_targets(spark, sf))
    wide = features.weather_features(features.flat_features(rows), 3, 2, ignore_missing=True)
    names = [f"{p}_{n}_avg" for p in "od" for n in ("vis", "temp", "wind")]
    return wide.select("trip_key", *(rounded(n).alias(n) for n in names))


@query
def train_test_split(spark, sf):
    train, test, _ = features.prepare_dataset(packed_targets(spark, sf), "D2", REPORT_TH)
    return train.select("trip_key", "label", F.lit("train").alias("part")).unionByName(
        test.select("trip_key", "label", F.lit("test").alias("part"))
    )


@query
def clf_metrics(spark, sf):
    m = measures(spark, sf)
    guessed = m.select(
        (F.col("ARR_DELAY_NEW") >= REPORT_TH).cast("double").alias("label"),
        (F.col("ARR_NASW") >= 50).cast("double").alias("prediction"),
    )
    scores = models.classification_metrics(guessed)
    return scores.select(*(rounded(c).alias(c) for c in scores.columns))


SMALL_FOREST = models.ForestSettings(trees=10, depth=5)


def stored_targets(spark, sf):
    """Targets written once, a row per trip without its timelines, which a slice joins to its own trips."""
    parts = stages.packed_targets_stored(*silver_tables(spark, sf), targets.THRESHOLDS)
    rows, strips = (
        files.read_table(spark, _stored_once(spark, name, sf, lambda: part, []), part.schema)
        for name, part in zip(("targets", "strips"), parts)
    )
    return timeline.attach_stored(rows, strips)


def stored_slice(spark, sf):
    """The rows of one slice, written once, so that several passes do not recompute them."""
    rows = targets.target_slice(packed_targets(spark, sf), "D2", REPORT_TH)
    path = _stored_once(spark, "slice", sf, lambda: rows, [])
    return files.read_table(spark, path, rows.schema)


@query
def ml_rf(spark, sf):
    train, test, names = features.prepare_dataset(
        stored_slice(spark, sf), "D2", REPORT_TH, origin_hours=3, dest_hours=3
    )
    model, scores = models.fit_and_score(train, test, names, models.ForestSettings())
    weights = models.feature_importances(spark, model).agg(
        F.count(F.lit(1)).alias("features"), rounded(F.sum("importance")).alias("importance")
    )
    parts = [models.row_counts(p) for p in (train, test)]
    counts = spark.createDataFrame(
        [(*parts[0], *parts[1], all(0 <= scores[a] <= 1 for a in ("auc_roc", "auc_pr")))],
        "train_rows long, train_positives long, test_rows long, test_positives long, areas_fit boolean",
    )
    return counts.join(F.broadcast(weights))


@query
def ml_grid(spark, sf):
    """All default experiments, with small forests; the counts do not depend on the forest."""
    rows = models.run_experiments(
        spark, stored_targets(spark, sf), forest=SMALL_FOREST, at_once=4
    )
    return rows.select(
        "tag",
        "ds",
        "th",
        "origin_hours",
        "dest_hours",
        "status",
        *(f"{p}_{n}" for p in ("train", "test") for n in ("rows", "positives")),
    )


@query
def stage_rerun(spark, sf):
    """Targets of stored stages after a first month and then a second one."""
    base = files.shared_folder(spark)
    parts = {
        "trips": (stand_ins.raw_trips(spark, sf), ".csv", "OP_CARRIER_AIRLINE_ID"),
        "readings": (stand_ins.raw_observations(spark, sf), "hourly.txt", "RelativeHumidity"),
    }
    months = ["201201", "201202"]
    for folder, (rows, suffix, column) in parts.items():
        for i, month in enumerate(months):
            part = rows.filter(F.col(column).cast("int") % 2 == i)
            part.write.option("header", True).csv(f"{base}/{folder}/{month}{suffix}")
    offsets(spark, sf).write.option("header", True).csv(f"{base}/mapping.csv")
    lake = stages.Lake(f"{base}/lake")

    def raw(upto):
        return stages.RawInputs(
            f"{base}/trips", f"{base}/readings", f"{base}/mapping.csv", months[:upto]
        )

    stages.run_gold(spark, raw(1), lake, thresholds=[REPORT_TH])
    stages.run_gold(spark, raw(2), lake, thresholds=[REPORT_TH])
    table = stages.targets_table(spark, raw(2), lake, thresholds=[REPORT_TH])
    return table.select(
        "trip_key",
        "ds",
        "th",
        "is_pos",
        F.col("C").alias("c_ref"),
        "year",
        "month",
        *_end_summary("o"),
    )


@query
def gold_incremental(spark, sf):
    """Targets after a third input month, and which parts that last run joined."""
    base = files.shared_folder(spark)
    months = ["201201", "201301", "201401"]
    sources = {
        "trips": (stand_ins.raw_trips(spark, sf), "FL_DATE", ".csv"),
        "readings": (stand_ins.raw_observations(spark, sf), "Date", "hourly.txt"),
    }
    for folder, (rows, column, suffix) in sources.items():
        year = F.coalesce(F.nullif(F.regexp_extract(column, "^201[34]|(?<=/)201[34]$", 0), F.lit("")), F.lit("2012"))
        for month in months:
            part = rows.filter(year == month[:4])
            part.write.option("header", True).csv(f"{base}/{folder}/{month}{suffix}")
    offsets(spark, sf).write.option("header", True).csv(f"{base}/mapping.csv")
    lake = stages.Lake(f"{base}/lake")

    def run(n):
        raw = stages.RawInputs(f"{base}/trips", f"{base}/readings", f"{base}/mapping.csv", months[:n])
        table = stages.run_gold(spark, raw, lake, thresholds=[REPORT_TH])
        return table, {e.part: e.joined for e in stages.manifest(spark, lake)}

    _, before = run(2)
    table, after = run(3)
    parts = [(p.year, p.month, before.get(p) != version) for p, version in sorted(after.items())]
    return (
        table.groupBy("ds", "th", "year", "month")
        .agg(
            F.count("*").alias("n"),
            F.sum("is_pos").alias("positives"),
            F.sum(F.size(F.filter("Wo", lambda p: p["o_vis"].isNotNull()))).alias("o_vis_seen"),
        )
        .join(spark.createDataFrame(parts, "year int, month string, joined_last boolean"), ["year", "month"])
    )


@query
def delay_quantile_sketches(spark, sf):
    """Monthly sketches, stored and merged: their count, and whether each quantile is within 0.01 of its rank."""
    flown, path = silver_trips(spark, sf), files.shared_folder(spark)
    files.write_table(quality.delay_sketches(flown), path)
    found = quality.sketched_quantiles(files.read_table(spark, path))
    errors = quality.rank_errors(flown, found).drop("n")
    held = [(F.col(q) <= 0.01).alias(f"{q}_held") for q in quality.QUANTILES]
    return found.select("column", "n").join(errors.select("column", *held), "column", "left")
