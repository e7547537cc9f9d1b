"""Data-quality reports: one aggregation per report, then long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType
from pyspark.sql.window import Window

# Column lists of the bronze and silver reports.
BRONZE_TRIP_KEYS = [
    "OP_CARRIER_AIRLINE_ID",
    "FL_NUM",
    "origin_airport_id",
    "dest_airport_id",
    "year",
    "month",
]
OBSERVATION_REPORT = [
    "airport_id",
    "WBAN",
    "obs_utc",
    "SkyCondition",
    "WeatherType",
    "Visibility",
    "TempC",
    "DewPointC",
    "RelativeHumidity",
    "WindSpeedKt",
    "WindDirection",
    "Altimeter",
    "SeaLevelPressure",
    "StationPressure",
    "HourlyPrecip",
    "year",
    "month",
]
OBSERVATION_KEYS = ["airport_id", "WBAN", "year", "month"]
SILVER_TRIP_KEYS = ["FL_NUM", "origin_airport_id", "dest_airport_id", "year", "month"]
OBSERVATION_FIELDS = [
    "Visibility",
    "DryBulbFarenheit",
    "DryBulbCelsius",
    "DewPointFarenheit",
    "DewPointCelsius",
    "RelativeHumidity",
    "WindSpeed",
    "WindDirection",
    "Altimeter",
    "SeaLevelPressure",
    "StationPressure",
    "HourlyPrecip",
    "SkyCondition",
    "WeatherType",
]
DELAY_COLUMNS = ["ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY", "total_weather_delay"]
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
LATE_MINUTES = 15
VIOLATION_COLUMNS = [
    "FL_DATE",
    "FL_NUM",
    "origin_airport_id",
    "dest_airport_id",
    "ARR_DELAY_NEW",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "total_weather_delay",
]


def long_form(wide: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn the columns of a one-row frame into the given rows."""
    return wide.select(
        F.inline(F.array(*(F.struct(*(c.alias(n) for n, c in r.items())) for r in rows)))
    )


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, NaN, blank, ``na`` or ``null``, as the type allows."""
    c, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(dtype, StringType):
        return c.isNull() | (F.trim(c) == "") | F.lower(c).isin("na", "null")
    return c.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: missing values per column and ``_rows``."""
    return df.agg(
        *(F.count_if(is_missing(df, c)).alias(c) for c in df.columns),
        F.count(F.lit(1)).alias("_rows"),
    )


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = True
) -> DataFrame:
    """One row: distinct values of the columns that exist, and ``_rows``."""
    present = [c for c in columns if c in df.columns]
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        *(count(F.col(c)).alias(c) for c in present), F.count(F.lit(1)).alias("_rows")
    )


def null_rates(df: DataFrame) -> DataFrame:
    """``(column, dtype, nulls, nans, total, null_rate, nan_rate)``, most nulls first."""
    sums, rows = [F.count(F.lit(1)).alias("total")], []
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        floating = isinstance(field.dataType, (DoubleType, FloatType))
        sums.append(F.count_if(c.isNull()).alias(f"null{i}"))
        sums.append(F.count_if(F.isnan(c) if floating else F.lit(False)).alias(f"nan{i}"))
        nulls, nans = F.col(f"null{i}"), F.col(f"nan{i}")
        rows.append(
            {
                "column": F.lit(field.name),
                "dtype": F.lit(field.dataType.simpleString()),
                "nulls": nulls,
                "nans": nans,
                "total": F.col("total"),
                "null_rate": F.round(F.try_divide(nulls, F.col("total")), 6),
                "nan_rate": F.round(F.try_divide(nans, F.col("total")), 6),
            }
        )
    return long_form(df.agg(*sums), rows).orderBy(F.desc("nulls"), "column")


def key_cardinalities(
    df: DataFrame, columns: Sequence[str] = tuple(SILVER_TRIP_KEYS), approximate: bool = True
) -> DataFrame:
    """``(column, approx_distinct)``, largest first; a marker row if no column exists."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [("__no_columns__", 0)], "column string, approx_distinct bigint"
        )
    counts = distinct_counts(df, present, approximate)
    rows = [{"column": F.lit(c), "approx_distinct": F.col(c)} for c in present]
    return long_form(counts, rows).orderBy(F.desc("approx_distinct"), "column")


#: Size of a distinct sketch as a power of two: a standard error of 0.65 %, at some 8 kilobytes a sketch.
KEY_SKETCH_BITS = 14


def key_sketches(
    df: DataFrame, columns: Sequence[str] = tuple(SILVER_TRIP_KEYS), by: Sequence[str] = ()
) -> DataFrame:
    """A sketch of the distinct values of each column that exists, and ``_rows``, per group.

    To be stored per month, and united instead of scanning again. Values count
    by their text; nulls are not counted. Rows are not expanded.
    """
    present = [c for c in columns if c in df.columns]
    sketches = (
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(KEY_SKETCH_BITS)).alias(f"{c}_keys") for c in present
    )
    return df.groupBy(*by).agg(*sketches, F.count(F.lit(1)).alias("_rows"))


def sketched_cardinalities(
    sketches: DataFrame, columns: Sequence[str] = tuple(SILVER_TRIP_KEYS)
) -> DataFrame:
    """``(column, approx_distinct, rows)`` of all groups of :func:`key_sketches`, largest first.

    Without any sketch the counts are 0.
    """
    present = [c for c in columns if f"{c}_keys" in sketches.columns]
    united = sketches.agg(
        *(F.hll_union_agg(f"{c}_keys").alias(c) for c in present), F.sum("_rows").alias("_rows")
    )
    rows = [
        {
            "column": F.lit(c),
            "approx_distinct": F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("bigint")),
            "rows": F.coalesce("_rows", F.lit(0).cast("bigint")),
        }
        for c in present
    ]
    return long_form(united, rows).orderBy(F.desc("approx_distinct"), "column")


def delay_quantiles(df: DataFrame) -> DataFrame:
    """``(column, p50, p90, p95, p99)`` of the delay columns that exist, exactly.

    Delays are whole minutes with few distinct values: they are counted per
    value first, on the map side as well, and the first value whose cumulated
    count reaches the rank is taken. The window sees one row per value.
    """
    present = [c for c in DELAY_COLUMNS if c in df.columns]
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in present
        )
    )
    counts = (
        df.select(F.inline(cells)).where("value is not null").groupBy("column", "value").count()
    )
    by = Window.partitionBy("column")
    placed = counts.withColumns(
        {
            "up_to": F.sum("count").over(by.orderBy("value")),
            "all": F.sum("count").over(by),
        }
    )
    reached = [
        F.min(F.when(F.col("up_to") >= F.ceil(F.col("all") * p), F.col("value"))).alias(n)
        for n, p in QUANTILES.items()
    ]
    found = placed.groupBy("column").agg(*reached)
    names = df.sparkSession.createDataFrame([(c,) for c in present], "column string")
    return names.join(found, "column", "left")


#: Size of a quantile sketch: ranks are off by less than 0.01 with near certainty, at some kilobytes a sketch.
SKETCH_K = 800


def delay_sketches(df: DataFrame, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """A quantile sketch of each delay column per group: to be stored, and merged instead of scanning again.

    One aggregation; partial sketches meet in the shuffle, never values. Nulls are not counted.
    """
    present = [c for c in DELAY_COLUMNS if c in df.columns]
    sketches = (F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_K)).alias(c) for c in present)
    return df.groupBy(*by).agg(*sketches)


def sketched_quantiles(sketches: DataFrame) -> DataFrame:
    """``(column, n, p50, p90, p95, p99)`` of all groups of :func:`delay_sketches`, within 0.01 of the rank.

    The exact form is :func:`delay_quantiles`. A column without values has null quantiles.
    """
    present = [c for c in DELAY_COLUMNS if c in sketches.columns]
    merged = sketches.agg(*(F.kll_merge_agg_double(c).alias(c) for c in present))
    cells = []
    for c in present:
        n = F.coalesce(F.kll_sketch_get_n_double(c), F.lit(0)).cast("bigint")
        found = (
            F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(c), F.lit(float(q)))).alias(name)
            for name, q in QUANTILES.items()
        )
        cells.append(F.struct(F.lit(c).alias("column"), n.alias("n"), *found))
    return merged.select(F.inline(F.array(*cells)))


def rank_errors(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``(column, n, p50, ...)``: how far each quantile's rank in the data is from the one asked for.

    A value holds the ranks from the share of smaller values to the share of values up to it.
    """
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in DELAY_COLUMNS
            if c in df.columns
        )
    )
    values = df.select(F.inline(cells)).where("value is not null")
    asked = quantiles.drop("n")
    errors = []
    for name, q in QUANTILES.items():
        below = F.avg((F.col("value") < F.col(name)).cast("int"))
        up_to = F.avg((F.col("value") <= F.col(name)).cast("int"))
        errors.append(F.greatest(below - q, F.lit(q) - up_to, F.lit(0.0)).alias(name))
    return values.join(asked, "column").groupBy("column").agg(F.count("*").alias("n"), *errors)


def delay_conditions() -> dict[str, Column]:
    """The four cells of cause against lateness; a null delay is in none."""
    caused = (F.col("WEATHER_DELAY") != 0) | (F.col("NAS_DELAY") != 0)
    uncaused = (F.col("WEATHER_DELAY") == 0) & (F.col("NAS_DELAY") == 0)
    is_late = F.col("ARR_DELAY_NEW") >= LATE_MINUTES
    in_time = F.col("ARR_DELAY_NEW") < LATE_MINUTES
    # Row labels of the rules report.
    return {
        "bothZero -> arr<15 (OK)": uncaused & in_time,
        "bothZero -> arr>=15 (VIOL)": uncaused & is_late,
        "nonZero -> arr>=15 (OK)": caused & is_late,
        "nonZero -> arr<15 (VIOL)": caused & in_time,
    }


def delay_rules(df: DataFrame) -> DataFrame:
    """``(check, rows)``: trips per rule cell and in total, from one scan."""
    cells = delay_conditions()
    sums = [F.count_if(rule).alias(f"n{i}") for i, rule in enumerate(cells.values())]
    rows = [{"check": F.lit(n), "rows": F.col(f"n{i}")} for i, n in enumerate(cells)]
    rows.append({"check": F.lit("total rows"), "rows": F.col("total")})
    return long_form(df.agg(*sums, F.count(F.lit(1)).alias("total")), rows)


def rule_violations(df: DataFrame, per_rule: int = 50) -> DataFrame:
    """The first ``per_rule`` violations of each rule, in column order."""
    shown = [c for c in VIOLATION_COLUMNS if c in df.columns]
    cells = delay_conditions()
    # Tags of the violation sample.
    tags = {
        "bothZero->arr>=15": cells["bothZero -> arr>=15 (VIOL)"],
        "nonZero->arr<15": cells["nonZero -> arr<15 (VIOL)"],
    }
    parts = [
        df.filter(rule)
        .select(*shown)
        .orderBy(*shown)
        .limit(per_rule)
        .withColumn("rule", F.lit(tag))
        for tag, rule in tags.items()
    ]
    return parts[0].unionByName(parts[1])


def observation_check(
    bronze: DataFrame, fields: Sequence[str] = tuple(OBSERVATION_FIELDS)
) -> DataFrame:
    """``(field, present, nulls, null_pct, total, stations)`` per key field.

    A field the table lacks is reported with ``present = false``.
    """
    present = [f for f in fields if f in bronze.columns]
    sums = [F.count_if(F.col(f).isNull()).alias(f"n_{f}") for f in present]
    rows = []
    for f in fields:
        nulls = F.col(f"n_{f}") if f in present else F.lit(None).cast("long")
        rows.append(
            {
                "field": F.lit(f),
                "present": F.lit(f in present),
                "nulls": nulls,
                "null_pct": F.try_divide(nulls * F.lit(100.0), F.col("total")),
                "total": F.col("total"),
                "stations": F.col("stations"),
            }
        )
    counts = bronze.agg(
        *sums,
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("WBAN").alias("stations"),
    )
    return long_form(counts, rows)


def observation_sample(bronze: DataFrame, n: int = 10) -> DataFrame:
    """The first readings by station and time, for inspection."""
    shown = [
        "WBAN",
        "obs_local_naive",
        "Visibility",
        "DryBulbCelsius",
        "WindSpeed",
        "HourlyPrecip",
    ]
    return bronze.select(*shown).orderBy(*shown).limit(n)
