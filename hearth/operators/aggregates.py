"""Aggregations. All of them combine map-side before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import hour_start
from ..functions.units import safe_ratio
from ..sizing import values_column


def avg_if(value: Column, condition: Column) -> Column:
    """Average over the rows where the condition holds; NULL if there are none."""
    return F.avg(F.when(condition, value))


def hourly_avg(df: DataFrame, ts: str, cols: Sequence[str], *, hour: str = "hour") -> DataFrame:
    return df.groupBy(hour_start(F.col(ts)).alias(hour)).agg(*[F.avg(c).alias(c) for c in cols])


def hourly_wide(
    df: DataFrame,
    ts: str,
    entity: str,
    value: str,
    columns: Mapping[str, str],
    *,
    hour: str = "hour_start",
) -> DataFrame:
    """Long sensor log to one row per hour with an average per listed sensor.

    Every hour with any row appears. All buffers are numeric, so this is one
    hash aggregation that leaves at most one row per hour and task to shuffle.
    """
    averages = [
        avg_if(F.col(value), F.col(entity) == F.lit(sensor)).alias(name)
        for sensor, name in columns.items()
    ]
    return df.groupBy(hour_start(F.col(ts)).alias(hour)).agg(*averages)


def latest(value: str, ts: str) -> Column:
    """Latest non-NULL value; equal times are settled by the greater value."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(ts, value)))


def latest_in_group(df: DataFrame, keys: Mapping[str, Column], value: str, ts: str) -> DataFrame:
    """Latest non-NULL ``value`` of each group; ``keys`` maps output names to columns.

    In two steps as in :func:`hourly_avg_with_last`: the large input is hashed by
    key and value with a numeric buffer, and values are compared among few rows.
    """
    named = [column.alias(name) for name, column in keys.items()]
    per_value = df.groupBy(*named, F.col(value)).agg(F.max(ts).alias("_seen"))
    return per_value.groupBy(*keys).agg(latest(value, "_seen").alias(value))


def hourly_avg_with_last(
    df: DataFrame, ts: str, cols: Sequence[str], last: str, *, hour: str = "hour"
) -> DataFrame:
    """Hourly averages plus the last non-NULL text of the hour.

    The text is a grouping key in the first step, so that step keeps numeric
    buffers and stays a hash aggregation over the large input; the text is
    only compared among the few rows an hour has left.
    """
    per_text = df.groupBy(hour_start(F.col(ts)).alias(hour), F.col(last)).agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in cols],
        *[F.count(c).alias(f"_n_{c}") for c in cols],
        F.max(ts).alias("_seen"),
    )
    return per_text.groupBy(hour).agg(
        *[safe_ratio(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(c) for c in cols],
        latest(last, "_seen").alias(last),
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Whole row with the greatest ``version`` for each key."""
    others = [c for c in df.columns if c not in keys]
    order = F.struct(version, *(tie_break or [c for c in others if c != version]))
    newest = F.max_by(F.struct(*others), order).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    return safe_ratio(F.sum(numerator), F.sum(denominator))


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def entity_counts(df: DataFrame, entity: str, expected: Sequence[str]) -> DataFrame:
    """Rows per expected sensor, with a flag on those that have none."""
    counted = df.groupBy(entity).agg(F.count("*").alias("_rows"))
    listed = values_column(df.sparkSession, entity, expected)
    records = F.coalesce("_rows", F.lit(0))
    return listed.join(counted, entity, "left").select(
        entity, records.alias("records"), (records == 0).alias("is_empty")
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once; NULL keys are not compared."""
    grouped = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("occurrences"))
    return grouped.filter(F.col("occurrences") > 1)


def coverage(df: DataFrame, entity: str, expected: Sequence[str]) -> DataFrame:
    """Which expected sensors the data has."""
    counts = entity_counts(df, entity, expected)
    return counts.select(entity, (~F.col("is_empty")).alias("present"))
