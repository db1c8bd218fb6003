"""Unions and replacement as set algebra."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct rows of all inputs; each input is deduplicated map-side first."""
    return union_all(*frames).distinct()


def replace_where(current: DataFrame, new: DataFrame, gone: Column) -> DataFrame:
    """``current`` without the rows where ``gone`` holds, plus ``new``.

    Rows for which ``gone`` is NULL are kept.
    """
    survivors = current.filter(~F.coalesce(gone, F.lit(False)))
    return survivors.unionByName(new)
