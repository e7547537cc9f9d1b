"""Numbered manifests: which folders make up a table right now.

A table's data lies in folders that are written once and never changed. A
manifest is a small table of its own, ``path/0000000007``, whose rows name those
folders. A commit writes the next number; readers take the highest number whose
write was finished. A job that breaks at any point leaves the former state, and
a reader sees one state or the other, never a mixture.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Row, SparkSession
from pyspark.sql.types import StructType

from delaylake.sources import files


def new_version() -> str:
    return f"version-{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in files.subfolders(spark, path) if n.isdigit())


def _folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{number:010d}"


def current(spark: SparkSession, path: str, schema: StructType) -> list[Row]:
    """The rows of the newest finished manifest; none before the first commit."""
    for number in reversed(_numbers(spark, path)):
        if files.table_exists(spark, _folder(path, number)):
            return files.read_table(spark, _folder(path, number), schema).collect()
    return []


def commit(spark: SparkSession, path: str, rows: Sequence[tuple], schema: StructType) -> None:
    """Make the rows the state of the table.

    Numbers of broken commits are skipped. A number that another writer has
    finished meanwhile is an error: nothing of either is lost, the run can be repeated.
    """
    number = max(_numbers(spark, path), default=0) + 1
    table = spark.createDataFrame(list(rows), schema).coalesce(1)
    table.write.mode("errorifexists").parquet(_folder(path, number))


def remove_former(spark: SparkSession, path: str) -> int:
    """Delete all manifests but the newest finished one; returns how many."""
    numbers = _numbers(spark, path)
    finished = [n for n in numbers if files.table_exists(spark, _folder(path, n))]
    former = [n for n in numbers if finished and n < finished[-1]]
    for number in former:
        files.remove_folder(spark, _folder(path, number))
    return len(former)


def remove_unused(spark: SparkSession, path: str, used: Iterable[str], prefix: str = "") -> list[str]:
    """Delete the version folders below a path that are not used; returns their names.

    ``prefix`` stands before the version in the names of the folders.
    """
    kept = {f"{prefix}{v}" for v in used}
    gone = [n for n in files.subfolders(spark, path) if n.startswith(f"{prefix}version-") and n not in kept]
    for name in gone:
        files.remove_folder(spark, f"{path.rstrip('/')}/{name}")
    return gone
