"""The rules that the built star schema has to keep."""

from __future__ import annotations

from ..operators.quality import Check


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, column, "not_null") for column in columns]


def _holds(table: str, rules: dict[str, str]) -> list[Check]:
    return [Check(table, column, "expression", expression) for column, expression in rules.items()]


def _parent(column: str, parent: str) -> Check:
    return Check("fact", column, "relationships", parent=parent, parent_key=column)


# The rules themselves.
DIMENSION_CHECKS = [
    Check("dim_device", "DeviceKey", "unique"),
    *_not_null("dim_device", "DeviceKey", "Brand", "Model", "InstallationDate"),
    *_holds("dim_device", {"MinPower": "MinPower >= 0"}),
    Check("dim_location", "LocationKey", "unique"),
    *_not_null(
        "dim_location", "LocationKey", "DeviceLocation", "ClosestWeatherStation", "PricingRegion", "ValidFrom"
    ),
    *_holds("dim_location", {"ValidTo": "ValidTo >= ValidFrom"}),
    Check("dim_time", "TimeKey", "unique"),
    *_not_null("dim_time", "TimeKey", "FullDate", "IsHoliday", "IsWeekend", "IsPeakHour"),
    *_holds(
        "dim_time",
        {
            "Year": "Year >= 2000",
            "Month": "Month BETWEEN 1 AND 12",
            "Day": "Day BETWEEN 1 AND 31",
            "DayOfWeek": "DayOfWeek BETWEEN 1 AND 7",
            "HourOfDay": "HourOfDay BETWEEN 0 AND 23",
            "Season": "Season IN ('Winter','Spring','Summer','Autumn')",
        },
    ),
]

FACT_CHECKS = [
    Check("fact", "FactKey", "unique"),
    *_not_null("fact", "FactKey", "TimeKey", "DeviceKey", "LocationKey", "ASHP_Power"),
    _parent("TimeKey", "dim_time"),
    _parent("DeviceKey", "dim_device"),
    _parent("LocationKey", "dim_location"),
    *_holds(
        "fact",
        {
            "ASHP_Power": "ASHP_Power >= 0",
            "IndoorHumidityPerc": "IndoorHumidityPerc BETWEEN 0 AND 100",
            "OutdoorHumidityPerc": "OutdoorHumidityPerc BETWEEN 0 AND 100",
            "UV_Index": "UV_Index >= 0",
            "AirPressure_mmHg": "AirPressure_mmHg BETWEEN 600 AND 800",
            "WindDir": "WindDir BETWEEN 0 AND 360",
            "WindSpeed_ms": "WindSpeed_ms >= 0",
            "WindGustSpeed_ms": "WindGustSpeed_ms >= 0",
        },
    ),
]

GOVERNANCE_CHECKS = [
    Check("fact", "TimeKey", "not_null"),
    Check("dim_device", "DeviceKey", "unique"),
    Check("fact", "ASHP_Power", "expression", "ASHP_Power BETWEEN 0 AND 10000"),
]

DIAGRAM_CHECKS = [
    Check("dim_device", "MaxPower", "expression", "MaxPower >= MinPower"),
    *_holds(
        "fact",
        {
            "Boiler_Power": "Boiler_Power >= 0",
            "Air_Drier_Power": "Air_Drier_Power >= 0",
            "Boiler_Voltage": "Boiler_Voltage >= 0",
            "CloudCoverage": "CloudCoverage BETWEEN 0 AND 100",
        },
    ),
]

STAR_CHECKS = DIMENSION_CHECKS + FACT_CHECKS
