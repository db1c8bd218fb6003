"""The five bronze tables and where each one lives below a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import BRONZE_DEVICE, BRONZE_IOT, BRONZE_LOCATION, BRONZE_PRICE, BRONZE_WEATHER
from .files import read_or_empty

BRONZE_TABLES: dict[str, T.StructType] = {
    "bronze_iot_raw_data": BRONZE_IOT,
    "bronze_weather_history": BRONZE_WEATHER,
    "bronze_price": BRONZE_PRICE,
    "bronze_device": BRONZE_DEVICE,
    "bronze_location": BRONZE_LOCATION,
}


def bronze_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_bronze(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One bronze table by name; empty when nothing has landed yet."""
    if name not in BRONZE_TABLES:
        raise KeyError(f"unknown bronze table {name!r}; expected one of {sorted(BRONZE_TABLES)}")
    schema = BRONZE_TABLES[name]
    return read_or_empty(spark, bronze_path(root, name), schema).select(*schema.names)


def register_bronze(spark: SparkSession, root: str) -> list[str]:
    """Temp views for all bronze tables."""
    for name in BRONZE_TABLES:
        read_bronze(spark, root, name).createOrReplaceTempView(name)
    return list(BRONZE_TABLES)
