"""Sorting and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: most rows a dashboard query returns.
DASHBOARD_ROWS = 5000


def sort_by(df: DataFrame, *cols: str) -> DataFrame:
    """Sort by names; a leading minus means descending."""
    keys = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in cols]
    return df.orderBy(*keys)


def sort_by_position(df: DataFrame, *positions: int) -> DataFrame:
    """Sort by 1-based output positions; negative means descending."""
    names = df.columns
    return sort_by(df, *[f"-{names[-p - 1]}" if p < 0 else names[p - 1] for p in positions])


def top(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """First ``n`` rows in the given order; end with a unique column."""
    return sort_by(df, *cols).limit(n)


def head(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` when an order is given."""
    return top(df, n, *cols) if cols else df.limit(n)


def dashboard_cap(df: DataFrame, *cols: str, limit: int = DASHBOARD_ROWS) -> DataFrame:
    return head(df, limit, *cols)
