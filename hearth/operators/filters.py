"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_prefix


def as_time(value) -> Column:
    """Literal, date, datetime or column as a timestamp column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    for col in cols:
        df = df.filter(F.col(col).isNotNull())
    return df


def half_open(df: DataFrame, col: str, low, high) -> DataFrame:
    """``low <= col < high``."""
    return df.filter((F.col(col) >= F.lit(low)) & (F.col(col) < F.lit(high)))


def inclusive(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.filter(F.col(col).between(F.lit(low), F.lit(high)))


def greater_than_column(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.filter(F.col(left) > F.col(right))


def equals(df: DataFrame, col: str, value) -> DataFrame:
    """Attribute equality; no filter when ``value`` is None."""
    return df if value is None else df.filter(F.col(col) == F.lit(value))


def in_list(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def in_window(ts: str, start, end) -> Column:
    """``start <= ts < end`` as a predicate."""
    return (F.col(ts) >= as_time(start)) & (F.col(ts) < as_time(end))


def time_window(df: DataFrame, ts: str, start, end, *, day: str | None = None) -> DataFrame:
    """Rows of ``[start, end)``; with ``day`` also prunes day partitions."""
    if day is not None:
        df = df.filter(day_range(day, start, end))
    return df.filter(in_window(ts, start, end))


def day_range(day: str, start, end) -> Column:
    """Days that ``[start, end)`` touches."""
    last = as_time(end) - F.expr("interval 1 microsecond")
    return F.col(day).between(F.to_date(as_time(start)), F.to_date(last))


def before_cutoff(df: DataFrame, ts: str, cutoff) -> DataFrame:
    return df.filter(F.col(ts) < as_time(cutoff))


def cutoff_report(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Rows kept before and skipped from ``cutoff`` on, in one pass."""
    late = F.col(ts) >= as_time(cutoff)
    return df.agg(
        F.count_if(~late).alias("kept"),
        F.count_if(late).alias("skipped"),
    )


def keep_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(has_prefix(F.col(col), prefix))


def drop_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Complement of :func:`keep_prefix`; NULL text has no prefix and stays."""
    return df.filter(~F.coalesce(has_prefix(F.col(col), prefix), F.lit(False)))


def free_or_negative_price(df: DataFrame, price: str) -> DataFrame:
    return df.filter(F.col(price) <= F.lit(0.0))


def nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Empty relation of a given schema."""
    return spark.createDataFrame([], schema)


def no_rows(df: DataFrame) -> DataFrame:
    """Same columns, never a row."""
    return df.filter(F.lit(False))


def with_time(df: DataFrame, ts: str) -> DataFrame:
    """Drops rows whose time is missing or could not be parsed."""
    return not_null(df, ts)
