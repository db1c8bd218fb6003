"""Checks that a frame is small before it is broadcast or numbered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a narrow dimension that are safe to hold on every executor.
SMALL_ROWS = 50_000


def fits(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def values_column(spark: SparkSession, name: str, values) -> DataFrame:
    """Fixed list of values as a one-column frame, built on the JVM side."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
