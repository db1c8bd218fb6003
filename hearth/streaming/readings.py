"""Streaming counterparts of the hourly models.

State is keyed by hour, or by (entity, time) for deduplication, and bounded by
the watermark. Output goes to a table through ``foreachBatch``; replaying a
batch rewrites the same keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import safe_number
from ..functions.time import local_date
from ..operators.aggregates import avg_if, latest, latest_in_group
from ..operators.joins import flag_join
from ..plans.gold import attach_versions
from ..plans.star import pinned_star
from ..schemas import BRONZE_IOT, SENSOR_COLUMNS
from ..sinks import days_of, on_days, read_days, staged_batch, upsert_rows, with_day

HOUR = "1 hour"


def stream_readings(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = BRONZE_IOT,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Landing folder as a stream; each file is read once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def hourly_wide_stream(
    readings: DataFrame, delay: str, sensors: Mapping[str, str] = SENSOR_COLUMNS
) -> DataFrame:
    """Tumbling one-hour averages, one column per sensor."""
    value = safe_number(F.col("state"))
    averages = [
        avg_if(value, F.col("entity_id") == F.lit(sensor)).alias(name) for sensor, name in sensors.items()
    ]
    return (
        readings.withWatermark("last_changed", delay)
        .groupBy(F.window("last_changed", HOUR).alias("_window"))
        .agg(*averages)
        .select(F.col("_window.start").alias("hour_start"), *sensors.values())
    )


def dedup_stream(readings: DataFrame, delay: str, keys: Sequence[str] = ("entity_id", "last_changed")) -> DataFrame:
    """Drops repeated deliveries of one state change; ``keys`` tell state changes apart."""
    return readings.withWatermark("last_changed", delay).dropDuplicatesWithinWatermark(list(keys))


def last_state_stream(observations: DataFrame, delay: str, value: str = "condition_state") -> DataFrame:
    """Last non-NULL state of each hour."""
    return (
        observations.withWatermark("last_changed", delay)
        .groupBy(F.window("last_changed", HOUR).alias("_window"))
        .agg(latest(value, "last_changed").alias(value))
        .select(F.col("_window.start").alias("hour_start"), value)
    )


def state_times_stream(observations: DataFrame, delay: str, value: str = "condition_state") -> DataFrame:
    """When each non-NULL state was last seen in each hour.

    The text is a grouping key and the buffer a time, so state is hashed and never sorted;
    :func:`last_state_sink` picks the last state of an hour among the few it has.
    """
    return (
        observations.filter(F.col(value).isNotNull())
        .withWatermark("last_changed", delay)
        .groupBy(F.window("last_changed", HOUR).alias("_window"), F.col(value))
        .agg(F.max("last_changed").alias("seen"))
        .select(F.col("_window.start").alias("hour_start"), value, "seen")
    )


def last_state_sink(table: str, value: str = "condition_state") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function from :func:`state_times_stream` (update mode) to the last state of each hour.

    Times go to a table beside ``table`` by hour and state; the hours of the batch are
    then read from it and their last states replace those of ``table``. Both writes
    replace their keys, so a batch that is run again changes nothing. Equal times are
    settled by the greater state, as in :func:`last_state_stream`.
    """
    times = f"{table.rstrip('/')}_times"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged_batch(batch, times) as (rows, _):
            upsert_rows(rows, times, "hour_start", ["hour_start", value])
            days = days_of(with_day(rows, "hour_start"))
            stored = read_days(spark, times, rows.schema).filter(on_days(days)).drop("ts_day")
            touched = stored.join(rows.select("hour_start").distinct(), "hour_start", "left_semi")
            last = latest_in_group(touched, {"hour_start": F.col("hour_start")}, value, "seen")
            upsert_rows(last, table, "hour_start", ["hour_start"])

    return write


def enrich_stream(
    rows: DataFrame, dim_device: DataFrame, dim_location: DataFrame, holidays: DataFrame, ts: str
) -> DataFrame:
    """Device version, location version and holiday flag from static tables, by the rules of the fact."""
    versioned = attach_versions(
        rows, dim_device, dim_location, ts, device=["DeviceKey", "Brand", "Model"], location=["LocationKey", "DeviceLocation"]
    )
    days = holidays.select(F.to_date("timestamp").alias("day"))
    dated = versioned.withColumn("_day", local_date(F.col(ts)))
    return flag_join(dated, days, "_day", "IsHoliday").drop("_day")


def enrich_sink(
    root: str, owner: str, holidays: DataFrame, ts: str, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that enriches a batch from the star that is current when it begins.

    The star below ``root`` may be rebuilt while the stream runs: a batch pins its
    version, so no build deletes what it reads, and the next batch sees the newer one.
    ``owner`` names the stream's pin; ``write`` is the sink of the enriched rows.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        with pinned_star(batch.sparkSession, root, owner) as star:
            write(enrich_stream(batch, star.dim_device, star.dim_location, holidays, ts), batch_id)

    return enrich


def upsert_interval_sink(table: str, ts: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that upserts into a day-partitioned table.

    A batch replaces stored rows with its own keys in the days it touches, so a
    replayed batch changes nothing and a late row does not erase its hour.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_rows(batch, table, ts, keys)

    return write


def append_sink(table: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps each batch in a folder of its own.

    The folder is named by the batch id and overwritten, so a replay of a batch
    does not append it twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch_id={batch_id}")

    return write


def upsert_result_sink(table: str, hour: str = "hour_start") -> Callable[[DataFrame, int], None]:
    """Sink for update-mode hourly results: the newest result of an hour wins."""
    return upsert_interval_sink(table, hour, [hour])


def drain(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "update",
) -> StreamingQuery:
    """Process everything that has landed, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query
