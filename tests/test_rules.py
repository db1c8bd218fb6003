"""The quality rules, stated independently of the library, with one violation of each."""

import datetime as dt

import pytest
from helpers import build, price, weather

from hearth.operators.quality import run_suite
from hearth.plans.suites import DIAGRAM_CHECKS, GOVERNANCE_CHECKS, STAR_CHECKS

# (table, column, kind, value that breaks the rule)
STAR_RULES = [
    ("dim_device", "DeviceKey", "unique", "repeat"),
    ("dim_device", "DeviceKey", "not_null", None),
    ("dim_device", "Brand", "not_null", None),
    ("dim_device", "Model", "not_null", None),
    ("dim_device", "MinPower", "expression", -1.0),
    ("dim_device", "InstallationDate", "not_null", None),
    ("dim_location", "LocationKey", "unique", "repeat"),
    ("dim_location", "LocationKey", "not_null", None),
    ("dim_location", "DeviceLocation", "not_null", None),
    ("dim_location", "ClosestWeatherStation", "not_null", None),
    ("dim_location", "PricingRegion", "not_null", None),
    ("dim_location", "ValidFrom", "not_null", None),
    ("dim_location", "ValidTo", "expression", dt.date(1800, 1, 1)),
    ("dim_time", "TimeKey", "unique", "repeat"),
    ("dim_time", "TimeKey", "not_null", None),
    ("dim_time", "FullDate", "not_null", None),
    ("dim_time", "Year", "expression", 1999),
    ("dim_time", "Month", "expression", 13),
    ("dim_time", "Day", "expression", 0),
    ("dim_time", "DayOfWeek", "expression", 8),
    ("dim_time", "HourOfDay", "expression", 24),
    ("dim_time", "Season", "expression", "Monsoon"),
    # flags are boolean here, so "0 or 1" comes down to being there
    ("dim_time", "IsHoliday", "not_null", None),
    ("dim_time", "IsWeekend", "not_null", None),
    ("dim_time", "IsPeakHour", "not_null", None),
    ("fact", "FactKey", "unique", "repeat"),
    ("fact", "FactKey", "not_null", None),
    ("fact", "TimeKey", "not_null", None),
    ("fact", "TimeKey", "relationships", 999_999),
    ("fact", "DeviceKey", "not_null", None),
    ("fact", "DeviceKey", "relationships", 999_999),
    ("fact", "LocationKey", "not_null", None),
    ("fact", "LocationKey", "relationships", 999_999),
    ("fact", "ASHP_Power", "not_null", None),
    ("fact", "ASHP_Power", "expression", -0.5),
    ("fact", "IndoorHumidityPerc", "expression", 100.5),
    ("fact", "OutdoorHumidityPerc", "expression", -0.5),
    ("fact", "UV_Index", "expression", -1.0),
    ("fact", "AirPressure_mmHg", "expression", 599.0),
    ("fact", "WindDir", "expression", 361.0),
    ("fact", "WindSpeed_ms", "expression", -1.0),
    ("fact", "WindGustSpeed_ms", "expression", -1.0),
]
GOVERNANCE_RULES = [
    ("fact", "TimeKey", "not_null", None),
    ("dim_device", "DeviceKey", "unique", "repeat"),
    ("fact", "ASHP_Power", "expression", 10_001.0),
]
DIAGRAM_RULES = [
    ("dim_device", "MaxPower", "expression", -1.0),
    ("fact", "Boiler_Power", "expression", -1.0),
    ("fact", "Air_Drier_Power", "expression", -1.0),
    ("fact", "Boiler_Voltage", "expression", -1.0),
    ("fact", "CloudCoverage", "expression", 101.0),
]


@pytest.fixture(scope="module")
def star(spark):
    from hearth.session import scratch_path

    pump = [("sensor.ohksoojus_power", "100", "2025-01-02 10:10:00")]
    observed = [("rain", "2025-01-02 10:20:00", 2.0)]
    return build(spark, scratch_path(spark, "rules"), pump, observed=observed, prices=[("2025-01-02 10:00:00", 50)])


@pytest.mark.parametrize(
    "checks, rules", [(STAR_CHECKS, STAR_RULES), (GOVERNANCE_CHECKS, GOVERNANCE_RULES), (DIAGRAM_CHECKS, DIAGRAM_RULES)]
)
def test_every_rule_is_checked_and_shows(spark, star, checks, rules):
    assert sorted((c.table, c.column, c.kind) for c in checks) == sorted(r[:3] for r in rules)
    assert run_suite(star.tables(), checks).filter("failing > 0").count() == 0
    broken = {}
    for name, df in star.tables().items():
        rows = [row.asDict() for row in df.collect()]
        good, key = rows[0], df.columns[0]
        for number, (_, column, kind, value) in enumerate([r for r in rules if r[0] == name]):
            row = good | {key: 1000 + number}
            if kind == "unique":
                rows += [row, dict(row)]
            else:
                rows.append(row | {column: value})
        broken[name] = spark.createDataFrame([tuple(r[c] for c in df.columns) for r in rows], df.schema)
    failing = {(r.table, r.column, r.check): r.failing for r in run_suite(broken, checks).collect()}
    assert len(failing) == len(rules) and {k: n for k, n in failing.items() if n != 1} == {}
