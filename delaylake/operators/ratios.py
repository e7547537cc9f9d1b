"""Calibration reports on the weather share of the delay (``ratio_adj``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake.operators.targets import delay_measures

# Grid and tolerances of the calibration report.
TAU_GRID = (0.80, 0.85, 0.90, 0.92, 0.95, 0.98, 1.00)
STRICT_TOLERANCE = 1e-6
LOOSE_TOLERANCE = 0.01
BUCKET_WIDTH = 0.05
BUCKET_END = 1.20


def ratio_measures(df: DataFrame, min_denominator: float = 1.0) -> DataFrame:
    return delay_measures(df, min_denominator, fill_nas_weather=True)


def explained() -> Column:
    return F.col("has_meteo") & (F.col("ARR_NASW") > 0)


def tau_counts(measures: DataFrame, grid: Sequence[float] = TAU_GRID) -> DataFrame:
    """``(tau, count)``: trips whose ratio reaches each bound, from one scan."""
    taus = sorted(set(grid))
    sums = [
        F.count_if(explained() & (F.col("ratio_adj") >= t)).alias(f"n{i}")
        for i, t in enumerate(taus)
    ]
    rows = [
        F.struct(F.lit(round(t, 2)).alias("tau"), F.col(f"n{i}").alias("count"))
        for i, t in enumerate(taus)
    ]
    return measures.agg(*sums).select(F.inline(F.array(*rows))).orderBy("tau")


def tau_one_counts(
    measures: DataFrame,
    strict: float = STRICT_TOLERANCE,
    loose: float = LOOSE_TOLERANCE,
) -> DataFrame:
    """One row: totals and the trips whose ratio is 1, strictly and loosely."""
    ratio = F.col("ratio_adj")
    return measures.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("has_meteo").alias("rows_with_meteo"),
        F.count_if(explained() & (F.abs(ratio - 1.0) <= strict)).alias("tau1_strict"),
        F.count_if(explained() & (ratio >= 1.0 - loose)).alias("tau1_loose"),
    )


def ratio_bucket(ratio: Column) -> Column:
    """Label of the 0.05-wide bucket, ``[0.10,0.15)``."""
    low = F.floor(ratio / BUCKET_WIDTH) * BUCKET_WIDTH
    return (
        F.when(F.isnan(ratio) | (F.abs(ratio) == float("inf")), "NaN/Inf")
        .when(ratio < 0, "<0.00")
        .when(ratio >= BUCKET_END, ">=1.20")
        .otherwise(F.format_string("[%.2f,%.2f)", low, low + BUCKET_WIDTH))
    )


def ratio_histogram(measures: DataFrame) -> DataFrame:
    """``(bucket, count)`` in the order of the labels."""
    bucket = F.when(F.col("ratio_adj").isNotNull(), ratio_bucket(F.col("ratio_adj")))
    return measures.groupBy(bucket.alias("bucket")).count().orderBy("bucket")
