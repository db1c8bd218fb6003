"""Hourly staging models over bronze tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import safe_number
from ..functions.units import hpa_to_mmhg, kmh_to_ms, mwh_to_kwh_price
from ..operators.aggregates import hourly_avg, hourly_avg_with_last, hourly_wide, latest_per_key
from ..operators.filters import with_time
from ..operators.keys import calendar_row_number, surrogate_key
from ..schemas import SENSOR_COLUMNS

WEATHER_COLUMNS = [
    "temperature_c",
    "dew_point_c",
    "humidity_perc",
    "cloud_coverage_pct",
    "uv_index",
    "air_pressure_mmhg",
    "wind_direction_deg",
    "wind_gust_speed_ms",
    "wind_speed_ms",
]


def stg_iot(bronze_iot: DataFrame, sensors: Mapping[str, str] = SENSOR_COLUMNS) -> DataFrame:
    """One row per hour with nine sensor averages."""
    readings = bronze_iot.select(
        "last_changed", "entity_id", safe_number(F.col("state")).alias("value")
    )
    return hourly_wide(with_time(readings, "last_changed"), "last_changed", "entity_id", "value", sensors)


def rename_weather(bronze_weather: DataFrame) -> DataFrame:
    """Bronze names and units to staging names and units."""
    return bronze_weather.select(
        F.col("last_changed").alias("timestamp_raw"),
        F.col("temperature_C").alias("temperature_c"),
        F.col("dew_point_C").alias("dew_point_c"),
        F.col("humidity_percent").alias("humidity_perc"),
        "cloud_coverage_pct",
        "uv_index",
        hpa_to_mmhg(F.col("pressure_hPa")).alias("air_pressure_mmhg"),
        F.col("wind_bearing_deg").alias("wind_direction_deg"),
        kmh_to_ms(F.col("wind_gust_speed_kmh")).alias("wind_gust_speed_ms"),
        kmh_to_ms(F.col("wind_speed_kmh")).alias("wind_speed_ms"),
        "condition_state",
    )


def stg_weather(bronze_weather: DataFrame) -> DataFrame:
    """One row per hour: averages, and the last condition of the hour."""
    observed = with_time(rename_weather(bronze_weather), "timestamp_raw")
    return hourly_avg_with_last(
        observed, "timestamp_raw", WEATHER_COLUMNS, "condition_state", hour="timestamp"
    )


def keyed_weather(stg: DataFrame) -> DataFrame:
    """Staged weather with its key in time order."""
    return calendar_row_number(stg, "timestamp", "WeatherKey")


def stg_price(bronze_price: DataFrame, *, zone: str | None = None, latest_only: bool = False) -> DataFrame:
    """One row per hour in EUR/kWh.

    ``latest_only`` keeps the newest ingestion of each price before averaging,
    for a store that appends corrections.
    """
    if zone is not None:
        bronze_price = bronze_price.filter(F.col("zone") == zone)
    if latest_only:
        prices = bronze_price.select("zone", "ts_utc", "ingestion_ts", "price_per_mwh")
        bronze_price = latest_per_key(prices, ["zone", "ts_utc"], "ingestion_ts", ["ingestion_ts", "price_per_mwh"])
    hourly = hourly_avg(with_time(bronze_price, "ts_utc"), "ts_utc", ["price_per_mwh"], hour="timestamp")
    return hourly.select(
        "timestamp", mwh_to_kwh_price(F.col("price_per_mwh")).alias("price_eur_per_kwh")
    )


def stg_device(bronze_device: DataFrame) -> DataFrame:
    return surrogate_key(bronze_device, ["Brand", "Model", "InstallationDate", "ValidTo"], "DeviceKey")


def stg_location(bronze_location: DataFrame) -> DataFrame:
    order = ["DeviceLocation", "ClosestWeatherStation", "PricingRegion", "ValidFrom", "ValidTo"]
    return surrogate_key(bronze_location, order, "LocationKey")
