"""Landed JSON payloads built from the feeds, in the shapes the readers expect.

Every source row becomes one small document of its own, with no grouping, so a
repeated row or key makes more documents and never a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import scratch_path
from hearth.sources.payloads import HOURLY_ARRAYS, WEATHER_ATTRIBUTES

from . import feeds

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
LATER = "interval 30 minutes"


def _write(df: DataFrame, document: Column, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.select(document.alias("value")).write.text(path)
    return path


def _later(ts: str) -> Column:
    return F.col(ts) + F.expr(LATER)


def iot_history(spark: SparkSession, sf_dir: str) -> str:
    """Two entity lists per document: the reading, and its sensor going away."""
    log = feeds.readings(spark, sf_dir)

    def record(state: Column, at: Column) -> Column:
        return F.struct(
            "entity_id",
            state.alias("state"),
            F.date_format(at, ISO + "'+00:00'").alias("last_changed"),
            F.from_json("attributes", "k int").alias("attributes"),
        )

    reading = record(F.col("state"), F.col("last_changed"))
    gone = record(F.lit("unavailable"), _later("last_changed"))
    return _write(log, F.to_json(F.array(F.array(reading), F.array(gone))), "iot-history")


def weather_history(spark: SparkSession, sf_dir: str) -> str:
    attributes = F.struct(*[F.col(name).alias(key) for name, key in WEATHER_ATTRIBUTES.items()])
    record = F.struct(
        "entity_id",
        F.col("condition_state").alias("state"),
        F.date_format("last_changed", ISO + "'Z'").alias("last_changed"),
        attributes.alias("attributes"),
    )
    return _write(feeds.weather(spark, sf_dir), F.to_json(F.array(F.array(record))), "weather-history")


def _price_payload(success: Column, *records: Column) -> Column:
    return F.to_json(F.struct(success.alias("success"), F.struct(F.array(*records).alias("ee")).alias("data")))


def price(spark: SparkSession, sf_dir: str) -> str:
    """Two prices per document; every seventh document is marked unsuccessful."""
    bought = feeds.events(spark, sf_dir).filter("event_type = 'purchase'")
    at, value = F.unix_timestamp("ts"), F.col("value") - 20
    now = F.struct(at.alias("timestamp"), value.alias("price"))
    later = F.struct((at + 1800).alias("timestamp"), (value / 2).alias("price"))
    return _write(bought, _price_payload(F.col("event_id") % 7 != 0, now, later), "price")


def _statistics_payload(entity: Column, *records: tuple[Column, Column, Column]) -> Column:
    """``{entity: [records]}`` put together as text, because ``start`` mixes types."""
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    texts = [
        F.concat(
            F.lit('{"start":'), start, F.lit(',"mean":'), number(mean), F.lit(',"min":'), number(mean),
            F.lit(',"max":null,"sum":null,"state":'), number(state), F.lit("}"),
        )
        for start, mean, state in records
    ]
    return F.concat(F.lit('{"'), entity, F.lit('":['), F.concat_ws(",", *texts), F.lit("]}"))


def statistics(spark: SparkSession, sf_dir: str) -> str:
    """Start times as seconds, milliseconds, ISO text or missing, by turns."""
    event_id, value = F.col("event_id"), F.col("value")
    start = (
        F.when(event_id % 17 == 0, F.lit("null"))
        .when(event_id % 3 == 0, F.unix_timestamp("ts").cast("string"))
        .when(event_id % 3 == 1, (F.unix_timestamp("ts") * 1000).cast("string"))
        .otherwise(F.date_format("ts", "'\"'yyyy-MM-dd'T'HH:mm:ss'+00:00\"'"))
    )
    mean, state = F.when(event_id % 5 != 0, value), F.when(event_id % 10 != 0, value)
    later = (F.unix_timestamp("ts") + 1800).cast("string")
    document = _statistics_payload(feeds.sensor_id(), (start, mean, state), (later, F.lit(None), value))
    return _write(feeds.events(spark, sf_dir), document, "statistics")


def _hourly_payload(arrays: dict[str, Column]) -> Column:
    hourly = F.struct(*[values.alias(name) for name, values in arrays.items()])
    return F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})


def hourly_weather(spark: SparkSession, sf_dir: str) -> str:
    """Two hours per document; the gust array is one value short."""
    observed = feeds.weather(spark, sf_dir).withColumn("uv_index", F.col("uv_index") * 25)
    arrays = {"time": F.array(F.date_format("last_changed", ISO), F.date_format(_later("last_changed"), ISO))}
    for name, source in HOURLY_ARRAYS.items():
        short = source == "wind_gusts_10m"
        arrays[source] = F.array(F.col(name)) if short else F.array(F.col(name), F.col(name) / 2)
    return _write(observed, _hourly_payload(arrays), "hourly-weather")


def backfill_weather(spark: SparkSession, sf_dir: str) -> str:
    observed = feeds.weather(spark, sf_dir).withColumn("uv_index", F.col("uv_index") * 25)
    arrays = {"time": F.array(F.date_format("last_changed", ISO))}
    arrays |= {source: F.array(F.col(name)) for name, source in HOURLY_ARRAYS.items()}
    return _write(observed, _hourly_payload(arrays), "backfill-weather")


def backfill_statistics(spark: SparkSession, sf_dir: str) -> str:
    """Sensor log as statistics, numeric states only."""
    start = F.date_format("last_changed", f"'\"'{ISO}'Z\"'")
    document = _statistics_payload(F.col("entity_id"), (start, F.col("state").try_cast("double"), F.lit(None)))
    return _write(feeds.readings(spark, sf_dir), document, "backfill-statistics")


def backfill_prices(spark: SparkSession, sf_dir: str) -> str:
    """One price per hour."""
    hourly = (
        feeds.prices(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "ts_utc").alias("hour"))
        .agg(F.avg("price_per_mwh").alias("price"))
    )
    record = F.struct(F.unix_timestamp("hour").alias("timestamp"), "price")
    return _write(hourly, _price_payload(F.lit(True), record), "backfill-prices")
