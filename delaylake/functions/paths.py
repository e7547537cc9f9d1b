"""Schema probing for frames that hold a field nested, flat or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def has_path(schema: StructType, path: str) -> bool:
    """Does the dotted path exist, ignoring case?"""
    node = schema
    for part in path.split("."):
        if not isinstance(node, StructType):
            return False
        match = [f for f in node.fields if f.name.lower() == part.lower()]
        if not match:
            return False
        node = match[0].dataType
    return True


def first_path(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((p for p in candidates if has_path(df.schema, p)), None)


def coalesce_paths(df: DataFrame, candidates: Sequence[str], default: Column) -> Column:
    """First non-null double among the candidate paths that exist, else ``default``."""
    found = [F.col(p).cast("double") for p in candidates if has_path(df.schema, p)]
    return F.coalesce(*found, default)


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def column_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    return column_or(df, name, F.lit(None).cast(dtype))
