"""Explicit schemas of every source, and the fixed sensor list."""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE_IOT = T.StructType(
    [
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("last_changed", T.TimestampType()),
        T.StructField("attributes", T.StringType()),
    ]
)

WEATHER_MEASURES = [
    "temperature_C",
    "pressure_hPa",
    "humidity_percent",
    "wind_speed_kmh",
    "wind_bearing_deg",
    "cloud_coverage_pct",
    "dew_point_C",
    "uv_index",
    "wind_gust_speed_kmh",
]

BRONZE_WEATHER = T.StructType(
    [
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("condition_state", T.StringType()),
        T.StructField("last_changed", T.TimestampType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in WEATHER_MEASURES]
)

BRONZE_PRICE = T.StructType(
    [
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("ts_utc", T.TimestampType()),
        T.StructField("zone", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("price_per_mwh", T.DoubleType()),
    ]
)

BRONZE_DEVICE = T.StructType(
    [
        T.StructField("Brand", T.StringType()),
        T.StructField("Model", T.StringType()),
        T.StructField("MinPower", T.DoubleType()),
        T.StructField("MaxPower", T.DoubleType()),
        T.StructField("InstallationDate", T.DateType()),
        T.StructField("ValidTo", T.DateType()),
    ]
)

BRONZE_LOCATION = T.StructType(
    [
        T.StructField("DeviceLocation", T.StringType()),
        T.StructField("ClosestWeatherStation", T.StringType()),
        T.StructField("PricingRegion", T.StringType()),
        T.StructField("ValidFrom", T.DateType()),
        T.StructField("ValidTo", T.DateType()),
    ]
)

HOLIDAYS = T.StructType(
    [
        T.StructField("timestamp", T.DateType()),
        T.StructField("name", T.StringType()),
    ]
)

READINGS_CSV = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("last_changed", T.StringType()),
    ]
)

# Sensor ids and the hourly column each one feeds.
SENSOR_COLUMNS = {
    "sensor.ohksoojus_power": "heat_pump_power_avg",
    "sensor.0xa4c138cdc6eff777_power": "boiler_power_avg",
    "sensor.ohukuivati_power": "air_drier_power_avg",
    "sensor.abshumidkuu2_absolute_humidity": "living_room_hum_abs_avg",
    "sensor.tempniiskuslauaall_humidity": "living_room_hum_perc_avg",
    "sensor.indoor_absolute_humidity": "wc_hum_abs_avg",
    "sensor.tempniiskuslauaall_temperature": "living_room_temp_avg",
    "sensor.indoor_outdoor_meter_3866": "wc_temp_avg",
    "sensor.0xa4c138cdc6eff777_voltage": "boiler_voltage_avg",
}

# Sensor ids and columns of the exploratory wide table.
RAW_COLUMNS = {
    "sensor.ohksoojus_power": "heat_pump_power",
    "sensor.0xa4c138cdc6eff777_power": "boiler_power",
    "sensor.abshumidkuu2_absolute_humidity": "living_room_hum_abs",
    "sensor.tempniiskuslauaall_humidity": "living_room_hum_perc",
    "sensor.tempniiskuslauaall_temperature": "living_room_temp",
    "sensor.indoor_outdoor_meter_3866": "wc_temp",
    "sensor.0xa4c138cdc6eff777_voltage": "boiler_voltage",
    "sensor.air_purifier_particulate_matter_2_5": "air_purifier_2_5",
    "sensor.air_purifier_particulate_matter_10": "air_purifier_10",
}

# Constants stamped on landed weather and price rows.
WEATHER_ENTITY = "weather.forecast_home"
UNKNOWN_CONDITION = "unknown"
PRICE_ZONE = "EE"
PRICE_CURRENCY = "EUR"
