"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of sources with different optional columns; a missing column is null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
