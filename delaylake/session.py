"""Session settings the operators are written for. All may change at run time."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SETTINGS = {
    # Local clock text is parsed in the session zone.
    "spark.sql.session.timeZone": "UTC",
    # The virtual machine only interprets methods above 8000 bytes. Wide
    # projections would fuse into such a method; below this limit Spark
    # evaluates them operator by operator, compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Sides that are dealt by some of their join columns need no further shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a side of a join at run time; negative where it never does."""
    size = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    text = (size or spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)(?:i?b)?", text).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")
