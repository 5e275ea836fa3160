"""Sorting of run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values
RUN_SORTS = ("startedAt", "finishedAt", "status", "entropy", "scup")
ARTIFACT_SORTS = ("createdAt", "size", "status", "name")


def sort_order(df: DataFrame, sort: str, allowed: Sequence[str], id_: str) -> list[Column]:
    """Order for ``field:asc`` or ``field:desc``; a missing date or number counts as 0, a missing text as empty."""
    field, _, direction = sort.partition(":")
    if field not in allowed or direction not in ("asc", "desc"):
        return []
    kind = df.schema[field].dataType
    if isinstance(kind, T.StringType):
        key = F.coalesce(F.col(field), F.lit(""))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        key = F.coalesce(F.col(field), F.lit("1970-01-01 00:00:00").cast(kind))
    else:
        key = F.coalesce(F.col(field), F.lit(0))
    return [key.asc() if direction == "asc" else key.desc(), F.col(id_).asc()]


def sort_runs(df: DataFrame, sort: str, allowed: Sequence[str] = RUN_SORTS, id_: str = "id") -> DataFrame:
    """Sorted rows; a sort that is not on the list changes nothing."""
    order = sort_order(df, sort, allowed, id_)
    return df.orderBy(*order) if order else df
