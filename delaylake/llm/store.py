"""Written tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from delaylake.sources.files import remove_folder

#: Tables that stages have written, by application; None outside a stage.
_LEFT: dict[str, list[str]] = {}
_now: list[str] | None = None

SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a session in one local process, as in tests, may lack the setting; its
    context then gets a temporary folder. A cluster without it is an error, since
    the executors would write to disks of their own.
    """
    context = spark.sparkContext
    base = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame as a written table: its lineage is cut, its size is known to the planner."""
    spark = df.sparkSession
    path = folder(spark)
    df.write.parquet(path)
    if _now is not None:
        _now.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage(docs: DataFrame) -> Iterator[None]:
    """A pipeline stage over ``docs``, the written result of the stage before.

    That result no longer needs the tables that earlier stages have stored on
    their way; they are deleted, unless ``docs`` still reads one of them. What
    is stored in the stage is kept until the next one begins. Tables that are
    stored outside of stages are never touched.
    """
    global _now
    spark = docs.sparkSession
    application = spark.sparkContext.applicationId
    left = _LEFT.pop(application, [])
    read = {part for name in docs.inputFiles() for part in name.split("/") if part.startswith("llm-")} if left else set()
    if any(path.rsplit("/", 1)[1] in read for path in left):
        _LEFT[application] = left
    else:
        for path in left:
            remove_folder(spark, path)
    outer, _now = _now, []
    try:
        yield
    finally:
        _LEFT.setdefault(application, []).extend(_now)
        _now = outer
