"""Star schema: calendar, device and location dimensions, hourly fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import (
    calendar_parts,
    is_peak,
    is_weekend,
    iso_weekday,
    local_date,
    local_wall,
    season,
    valid_from_or_default,
    valid_to_or_default,
)
from ..operators.filters import not_null
from ..operators.joins import flag_join, hour_join, instant_join, validity_join
from ..operators.key_registry import stable_key
from ..operators.keys import calendar_row_number, global_row_number, surrogate_key
from ..operators.sets import union_distinct

# Fact column: staging column. The order is the order of the fact table.
IOT_MEASURES = {
    "ASHP_Power": "heat_pump_power_avg",
    "Boiler_Power": "boiler_power_avg",
    "Air_Drier_Power": "air_drier_power_avg",
    "Boiler_Voltage": "boiler_voltage_avg",
    "IndoorTemp": "living_room_temp_avg",
    "IndoorHumidityPerc": "living_room_hum_perc_avg",
    "IndoorHumidityAbs": "living_room_hum_abs_avg",
    "WC_HumidityAbs": "wc_hum_abs_avg",
    "WC_Temp": "wc_temp_avg",
}
WEATHER_MEASURES = {
    "OutdoorTemp": "temperature_c",
    "DewPoint": "dew_point_c",
    "OutdoorHumidityPerc": "humidity_perc",
    "CloudCoverage": "cloud_coverage_pct",
    "UV_Index": "uv_index",
    "AirPressure_mmHg": "air_pressure_mmhg",
    "WindDir": "wind_direction_deg",
    "WindGustSpeed_ms": "wind_gust_speed_ms",
    "WindSpeed_ms": "wind_speed_ms",
    "WeatherCondition": "condition_state",
}
PRICE_MEASURES = {"ElectricityPrice": "price_eur_per_kwh"}
MEASURES = {**PRICE_MEASURES, **IOT_MEASURES, **WEATHER_MEASURES}


def needed_hours(stg_iot: DataFrame, stg_weather: DataFrame, stg_price: DataFrame) -> DataFrame:
    """Distinct hours that occur in any source."""
    return union_distinct(
        not_null(stg_iot.select(F.col("hour_start").alias("HourTs")), "HourTs"),
        not_null(stg_weather.select(F.col("timestamp").alias("HourTs")), "HourTs"),
        not_null(stg_price.select(F.col("timestamp").alias("HourTs")), "HourTs"),
    )


def calendar_columns(hours: DataFrame) -> DataFrame:
    """Local calendar fields of each hour instant."""
    local = hours.withColumn("_wall", local_wall(F.col("HourTs")))
    dated = local.withColumn("FullDate", F.to_date("_wall")).withColumns(calendar_parts(F.col("_wall")))
    return dated.withColumns(
        {
            "DayOfWeek": iso_weekday(F.col("FullDate")),
            "Season": season(F.col("Month")),
            "IsPeakHour": is_peak(F.col("HourOfDay")),
        }
    ).withColumn("IsWeekend", is_weekend(F.col("DayOfWeek")))


def dim_time(hours: DataFrame, holidays: DataFrame, *, registry: str | None = None) -> DataFrame:
    """Sparse calendar; ``HourTs`` carries the instant that facts join on.

    With a ``registry`` an hour keeps its key when others arrive later; else keys are
    dense in time order. So for the other models.
    """
    flagged = flag_join(
        calendar_columns(hours), holidays.select(F.to_date("timestamp")), "FullDate", "IsHoliday"
    )
    if registry is None:
        keyed = calendar_row_number(flagged, "HourTs", "TimeKey")
    else:
        keyed = stable_key(flagged, ["HourTs"], "TimeKey", f"{registry}/time")
    return keyed.select(
        "TimeKey",
        "FullDate",
        "Year",
        "Month",
        "Day",
        "DayOfWeek",
        "HourOfDay",
        "Season",
        "IsHoliday",
        "IsWeekend",
        "IsPeakHour",
        "HourTs",
    )


def dim_device(bronze_device: DataFrame, *, registry: str | None = None) -> DataFrame:
    """Named device versions with an open end filled in; with a ``registry`` a row that is
    repeated in all its columns is one version."""
    named = not_null(bronze_device, "Brand", "Model").withColumn(
        "ValidTo", valid_to_or_default(F.col("ValidTo"))
    )
    if registry is None:
        keyed = surrogate_key(named, ["Brand", "Model", "InstallationDate", "ValidTo"], "DeviceKey")
    else:
        natural = ["Brand", "Model", "InstallationDate", "ValidTo", "MinPower", "MaxPower"]
        keyed = stable_key(named.select(*natural).distinct(), natural, "DeviceKey", f"{registry}/device")
    return keyed.select(
        "DeviceKey", "Brand", "Model", "MinPower", "MaxPower", "InstallationDate", "ValidTo"
    )


def dim_location(bronze_location: DataFrame, *, registry: str | None = None) -> DataFrame:
    """Complete location versions with open ends filled in; repeated rows as in :func:`dim_device`."""
    text = ["DeviceLocation", "ClosestWeatherStation", "PricingRegion"]
    named = not_null(bronze_location, *text).withColumns(
        {
            "ValidFrom": valid_from_or_default(F.col("ValidFrom")),
            "ValidTo": valid_to_or_default(F.col("ValidTo")),
        }
    )
    natural = [*text, "ValidFrom", "ValidTo"]
    if registry is None:
        keyed = surrogate_key(named, natural, "LocationKey")
    else:
        keyed = stable_key(named.select(*natural).distinct(), natural, "LocationKey", f"{registry}/location")
    return keyed.select("LocationKey", *text, "ValidFrom", "ValidTo")


def project_measures(hourly: DataFrame, *keep: str) -> DataFrame:
    """Staging columns under their fact names."""
    return hourly.select(*keep, *[F.col(source).alias(name) for name, source in MEASURES.items()])


def fact_base(
    *, stg_iot: DataFrame, stg_weather: DataFrame, stg_price: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """One row per sensor hour with weather and price where they exist."""
    timed = instant_join(stg_iot, dim_time.select("HourTs", "TimeKey"))
    with_weather = hour_join(timed, stg_weather.withColumnRenamed("timestamp", "hour_start"), "hour_start")
    with_price = hour_join(
        with_weather, stg_price.withColumnRenamed("timestamp", "hour_start"), "hour_start"
    )
    return project_measures(with_price, "hour_start", "TimeKey")


def attach_versions(
    base: DataFrame,
    dim_device: DataFrame,
    dim_location: DataFrame,
    ts: str = "hour_start",
    *,
    device: Sequence[str] = ("DeviceKey",),
    location: Sequence[str] = ("LocationKey",),
) -> DataFrame:
    """Device and location versions valid on the local day of ``ts``; works on streams too.

    A device without an installation date is valid from the default date on.
    """
    dated = base.withColumn("_day", local_date(F.col(ts)))
    devices = dim_device.withColumn("_since", valid_from_or_default(F.col("InstallationDate")))
    with_device = validity_join(dated, devices, "_day", "_since", "ValidTo", carry=list(device))
    return validity_join(
        with_device, dim_location, "_day", "ValidFrom", "ValidTo", carry=list(location)
    ).drop("_day")


def fact_energy(
    *,
    stg_iot: DataFrame,
    stg_weather: DataFrame,
    stg_price: DataFrame,
    dim_time: DataFrame,
    dim_device: DataFrame,
    dim_location: DataFrame,
    stage_path: str | None = None,
    registry: str | None = None,
) -> DataFrame:
    """Hourly fact with dense ``FactKey`` over (TimeKey, DeviceKey, LocationKey)."""
    base = fact_base(
        stg_iot=stg_iot, stg_weather=stg_weather, stg_price=stg_price, dim_time=dim_time
    )
    keys = ["TimeKey", "DeviceKey", "LocationKey"]
    rows = attach_versions(base, dim_device, dim_location).drop("hour_start")
    if registry is None:
        keyed = global_row_number(rows, keys, "FactKey", stage_path=stage_path)
    else:
        keyed = stable_key(rows, keys, "FactKey", f"{registry}/fact")
    return keyed.select("FactKey", *keys, *MEASURES)
