"""Readers for landed payloads, flat files and stored tables."""

from .files import read_or_empty, read_price_table, read_readings_csv, read_scd_csv, read_seed
from .payloads import (
    bad_documents,
    read_hourly_weather,
    read_iot_history,
    read_price,
    read_statistics,
    read_weather_history,
)
from .registry import BRONZE_TABLES, read_bronze, register_bronze

__all__ = [
    "bad_documents",
    "BRONZE_TABLES",
    "read_bronze",
    "read_hourly_weather",
    "read_iot_history",
    "read_or_empty",
    "read_price",
    "read_price_table",
    "read_readings_csv",
    "read_scd_csv",
    "read_seed",
    "read_statistics",
    "read_weather_history",
    "register_bronze",
]
