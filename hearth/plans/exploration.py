"""Exploratory wide table: one column per sensor and timestamp."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import in_list
from ..operators.joins import outer_merge
from ..operators.keys import repeat_number
from ..operators.ordering import sort_by
from ..schemas import RAW_COLUMNS
from ..session import scratch_path

# Columns drawn together.
SERIES_GROUPS = {
    "temperature": ["living_room_temp", "wc_temp"],
    "particulates": ["air_purifier_2_5", "air_purifier_10"],
    "power": ["heat_pump_power", "boiler_power"],
    "humidity": ["living_room_hum_perc", "living_room_hum_abs"],
}


def sensor_slice(readings: DataFrame, sensor: str, name: str) -> DataFrame:
    """``(timestamp, value)`` of one sensor, renamed."""
    return readings.filter(F.col("entity_id") == sensor).select(
        F.col("last_changed").alias("timestamp"), F.col("state").alias(name)
    )


def merge_sensors(readings: DataFrame, columns: Mapping[str, str] = RAW_COLUMNS) -> DataFrame:
    """Outer merge of the per-sensor slices, for sensors that never repeat a timestamp:
    repeated ones multiply, as in any join."""
    return outer_merge([sensor_slice(readings, s, name) for s, name in columns.items()], "timestamp")


def wide_raw(readings: DataFrame, columns: Mapping[str, str] = RAW_COLUMNS) -> DataFrame:
    """One row per timestamp with a column for each sensor.

    Where a sensor repeats a timestamp, its readings are numbered by value, and
    there is one row per timestamp and number: the first readings of all sensors
    side by side, then the second ones, and so on. An outer merge would give every
    combination instead. Readings without a timestamp stay rows of their own.

    The log is read once, by an aggregation that also counts readings; only for
    timestamps that some sensor repeats it is read again, to number them.
    """
    known = in_list(readings, "entity_id", list(columns)).select("last_changed", "entity_id", "state")
    timed = known.filter(F.col("last_changed").isNotNull())

    def own(sensor: str, name: str) -> Column:
        return F.when(F.col("entity_id") == sensor, F.col("state")).alias(name)

    def merged(rows: DataFrame, *keys: str, **further: Column) -> DataFrame:
        wide = rows.select(*keys, "entity_id", *[own(sensor, name) for sensor, name in columns.items()])
        values = [F.any_value(name, ignoreNulls=True).alias(name) for name in columns.values()]
        return wide.groupBy(*keys).agg(*values, *[value.alias(name) for name, value in further.items()])

    most = F.greatest(*[F.count_if(F.col("entity_id") == sensor) for sensor in columns], F.lit(0))
    path = scratch_path(readings.sparkSession, "wide")
    merged(timed, "last_changed", _most=most).write.parquet(path)
    once = readings.sparkSession.read.parquet(path)
    repeated = once.filter("_most > 1").select("last_changed")
    wide = once.filter("_most <= 1").select(F.col("last_changed").alias("timestamp"), *columns.values())
    if not repeated.isEmpty():
        several = timed.join(repeated, "last_changed", "left_semi")
        numbered = repeat_number(several, ["entity_id", "last_changed"], ["state"], "_number")
        more = merged(numbered, "last_changed", "_number").withColumnRenamed("last_changed", "timestamp")
        wide = wide.unionByName(more.drop("_number"))
    untimed = known.filter(F.col("last_changed").isNull())
    alone = untimed.select(F.col("last_changed").alias("timestamp"), *[own(s, name) for s, name in columns.items()])
    return wide.unionByName(alone)


def series(wide: DataFrame, group: str) -> DataFrame:
    """Time-ordered series of one sensor group."""
    return sort_by(wide.select("timestamp", *SERIES_GROUPS[group]), "timestamp")
