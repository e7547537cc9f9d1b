"""Readers and writers.

The stages read text files as strings by header name: no inference pass over
the data, and dirty numbers are handled by ``try_cast`` in the bronze
projections. :func:`read_typed` is the reader for files of unknown types.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def monthly_paths(folder: str, months: Iterable[str], suffix: str = ".csv") -> list[str]:
    """``['201201'] -> ['folder/201201.csv']``."""
    return [f"{folder.rstrip('/')}/{m}{suffix}" for m in months]


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    sep: str = ",",
    header: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Text files as strings.

    With ``columns`` each path is read by its own header and the named columns
    are picked, so paths may order their columns differently; a missing one is
    an error. Without, all paths must have the header of the first.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if columns is None:
        return reader.csv(list(paths))
    parts = [require_columns(reader.csv(p), columns).select(*columns) for p in paths]
    return reduce(DataFrame.union, parts)


#: Types that inference tries, narrowest first; text fits always.
INFERRED = ("int", "bigint", "double", "boolean", "date", "timestamp")
LINE = "_line"


def _text_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != LINE]


def _filled(name: str) -> Column:
    return F.trim(F.col(f"`{name}`")) != ""


def _fits(name: str, dtype: str) -> Column:
    """Is a filled value of the type? A date has no time of day, a number no letter for its type."""
    value = F.trim(F.col(f"`{name}`"))
    known = value.try_cast(dtype).isNotNull()
    if dtype == "boolean":
        return F.lower(value).isin("true", "false")
    if dtype == "date":
        return known & value.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return known & ~value.rlike("[dDfF]$") if dtype == "double" else known


def infer_types(rows: DataFrame, tolerance: float = 0.0) -> dict[str, str]:
    """The narrowest type of each text column that all its values fit, but for a share.

    One aggregation for all columns; one row reaches the driver. Blank values
    fit any type; a column without values stays text. Lines that could not be
    split (``_line`` set) have no say.
    """
    names = _text_columns(rows)
    whole = rows.where(F.col(LINE).isNull()) if LINE in rows.columns else rows
    sums = []
    for i, name in enumerate(names):
        sums.append(F.count_if(_filled(name)).alias(f"n{i}"))
        for t in INFERRED:
            sums.append(F.count_if(_filled(name) & _fits(name, t)).alias(f"{t}{i}"))
    found = whole.agg(*sums).first()
    types = {}
    for i, name in enumerate(names):
        n = found[f"n{i}"]
        fitting = (t for t in INFERRED if n and n - found[f"{t}{i}"] <= tolerance * n)
        types[name] = next(fitting, "string")
    return types


def read_typed(
    spark: SparkSession,
    paths: Sequence[str],
    sep: str = ",",
    columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
    tolerance: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the quarantine of the lines that do not fit.

    Columns are named by the header of the paths, or by ``columns`` where they
    have none. ``types`` saves the pass that infers them; a column it leaves
    out is text. With a ``tolerance`` a column keeps its type although up to
    that share of its values do not fit, and their lines are set aside.

    The quarantine has the values as text, ``_line`` (the whole line where it
    has too few or too many values) and ``_misfits`` (the columns whose value
    does not fit the type). Blank values are null. Every line is in exactly one
    of the two frames.
    """
    reader = spark.read.option("sep", sep).option("header", columns is None)
    names = list(columns) if columns else reader.csv(list(paths)).columns
    shape = StructType([StructField(n, StringType()) for n in [*names, LINE]])
    # A pruned line is only split as far as asked: what is malformed would depend on the columns used later.
    reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", LINE)
    rows = reader.option("mode", "PERMISSIVE").schema(shape).csv(list(paths))
    if types is None:
        types = infer_types(rows, tolerance)
    wanted = {n: types.get(n, "string") for n in names}
    misfits = F.filter(
        F.array(
            F.lit(None).cast("string"),
            *(
                F.when(_filled(n) & ~_fits(n, t), F.lit(n))
                for n, t in wanted.items()
                if t != "string"
            ),
        ),
        lambda name: name.isNotNull(),
    )
    judged = rows.withColumn("_misfits", misfits)
    # Always true; without a column of the file beside the line's own, Spark refuses the scan.
    asked = F.col(f"`{names[0]}`").isNull() | (F.length(f"`{names[0]}`") >= 0)
    fits = F.col(LINE).isNull() & (F.size("_misfits") == 0) & asked
    typed = judged.where(fits).select(
        *(
            F.col(f"`{n}`").alias(n) if t == "string" else F.trim(F.col(f"`{n}`")).try_cast(t).alias(n)
            for n, t in wanted.items()
        )
    )
    return typed, judged.where(~fits)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job when a needed column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns in input: {', '.join(missing)}")
    return df


def reject_duplicate_columns(df: DataFrame) -> DataFrame:
    """Fail when two columns differ only in case."""
    names = [c.lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"duplicate columns: {', '.join(twice)}")
    return df


def table_exists(spark: SparkSession, path: str) -> bool:
    """Was a table written to the path to its end?

    The marker of a finished write is asked for, so a folder that a broken job
    left behind is no table. Only the path is looked up; no job runs.
    """
    try:
        spark.read.text(f"{path.rstrip('/')}/_SUCCESS")
    except AnalysisException:
        return False
    return True


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    parts: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Read a stage table, or some of its part folders.

    Give the schema to keep ``month`` as text (``'01'``) and the column order;
    partition columns would otherwise be typed by their values and come last.
    ``fmt`` is any format that the session has a reader for.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if parts is None:
        df = reader.load(path)
    else:
        base = path.rstrip("/")
        df = reader.option("basePath", base).load([f"{base}/{p}" for p in parts])
    return df if schema is None else df.select(*schema.names)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace_only_written: bool = False,
    max_records_per_file: int = 5_000_000,
    fmt: str = "parquet",
) -> None:
    """Overwrite a partitioned table.

    Rows are rebalanced on the partition columns: few files per partition, and
    adaptive execution splits a partition that holds far more than the others.
    ``replace_only_written`` keeps partitions that this frame does not touch,
    also those that it would have replaced by nothing.
    """
    laid_out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = (
        laid_out.write.format(fmt)
        .mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option(
            "partitionOverwriteMode", "dynamic" if replace_only_written else "static"
        )
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file. For report frames, whose row count is fixed by their columns."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one all executors share (``spark.checkpoint.dir``)."""
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path in its own type: for names only, never for data."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none where it does not exist."""
    system, location = _hadoop_path(spark, path)
    if not system.exists(location):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(location) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; none there is no error."""
    system, location = _hadoop_path(spark, path)
    system.delete(location, True)
