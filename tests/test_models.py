"""Hand-made cases for time, parsing, bins and the star schema."""

import datetime as dt

import pytest
from helpers import build, iot, price, tuples, utc, weather
from pyspark.sql import functions as F

from hearth.functions import bins, parse, text, time, units
from hearth.operators.quality import Check, run_suite
from hearth.plans import access, analytics, gold, silver
from hearth.plans.suites import DIAGRAM_CHECKS, GOVERNANCE_CHECKS, STAR_CHECKS

PUMP = "sensor.ohksoojus_power"
INDOOR = "sensor.tempniiskuslauaall_temperature"


def one(spark, expression, value, type_="string"):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return df.select(expression(F.col("x"))).first()[0]


def hours(first, count):
    start = utc(first)
    return [(start + dt.timedelta(hours=i)).isoformat(sep=" ") for i in range(count)]


@pytest.mark.parametrize(
    "state,expected",
    [
        ("unavailable", None), ("", None), ("1.5d", None), ("1e3", 1000.0), ("-.5", -0.5), ("7.", 7.0),
        ("nan", None), ("inf", None), ("1e999", None), (" 12 ", None), (None, None), ("+3", 3.0),
    ],
)
def test_safe_number(spark, state, expected):
    assert one(spark, parse.safe_number, state) == expected


@pytest.mark.parametrize(
    "x,floor5,trunc5", [(-2.5, -5.0, 0.0), (-7.5, -10.0, -5.0), (2.7, 0.0, 0.0), (5.0, 5.0, 5.0), (-5.0, -5.0, -5.0)]
)
def test_bins(spark, x, floor5, trunc5):
    assert one(spark, lambda c: bins.floor_bin(c, 5), x, "double") == floor5
    assert one(spark, lambda c: bins.trunc_bin(c, 5), x, "double") == trunc5


def test_price_bin_edge_follows_double_arithmetic(spark):
    assert one(spark, lambda c: bins.floor_bin(c, 0.05), 0.15, "double") == 0.1


@pytest.mark.parametrize("x,label", [(1.2, "1...1.5"), (-0.1, "-0.5...0"), (0.0, "0...0.5"), (None, None)])
def test_half_range_label(spark, x, label):
    assert one(spark, text.half_range_label, x, "double") == label


def test_power_range_label(spark):
    assert one(spark, lambda c: text.width_range_label(c, 100), 250.0, "double") == "200...300"


@pytest.mark.parametrize("radiation,uv", [(62.5, 2.0), (87.5, 4.0), (None, None)])
def test_uv_rounds_half_to_even(spark, radiation, uv):
    assert one(spark, units.uv_from_radiation, radiation, "double") == uv


@pytest.mark.parametrize("start", ["1761955200", "1761955200000", "2025-11-01T00:00:00Z", "2025-11-01T02:00:00+02:00"])
def test_epoch_or_iso(spark, start):
    assert one(spark, time.from_epoch_or_iso, start) == utc("2025-11-01")


@pytest.mark.parametrize("bad", ["soon", "12:30", "", None, "1e30", "2025-13-01T00:00:00Z"])
def test_unparseable_time_is_null(spark, bad):
    assert one(spark, time.from_epoch_or_iso, bad) is None


def test_zero_denominator_gives_null(spark):
    assert one(spark, lambda c: units.safe_ratio(F.lit(1.0), c), 0.0, "double") is None


def test_last_chunk_is_short(spark):
    df = spark.createDataFrame([(utc("2025-10-01"), utc("2026-01-15 05:00:00"))], "a timestamp, b timestamp")
    rows = time.chunk_ranges(df, "a", "b", 90).orderBy("chunk_start").collect()
    assert [(r.chunk_start, r.chunk_end) for r in rows] == [
        (utc("2025-10-01"), utc("2025-12-30")),
        (utc("2025-12-30"), utc("2026-01-15 05:00:00")),
    ]
    assert time.chunk_ranges(df.select("b", F.col("a").alias("c")), "b", "c", 90).count() == 0


def test_cutoff_is_start_of_previous_hour(spark):
    assert one(spark, time.backfill_cutoff, utc("2025-11-05 10:40:00"), "timestamp") == utc("2025-11-05 09:00:00")


def test_autumn_clock_change_keeps_both_hours(spark, folder):
    readings = [(PUMP, "100", t) for t in hours("2025-10-25 21:00:00", 25)]
    star = build(spark, folder, readings)
    calendar = {r.HourTs: r for r in star.dim_time.collect()}
    assert calendar[utc("2025-10-26 00:00:00")].HourOfDay == 3
    assert calendar[utc("2025-10-26 01:00:00")].HourOfDay == 3
    local_day = star.fact.join(star.dim_time, "TimeKey").filter("FullDate = '2025-10-26'")
    assert local_day.count() == 25
    assert local_day.select("TimeKey").distinct().count() == 25


def test_spring_clock_change_has_no_hour_three(spark, folder):
    readings = [(PUMP, "100", t) for t in hours("2025-03-29 22:00:00", 23)]
    star = build(spark, folder, readings)
    day = star.fact.join(star.dim_time, "TimeKey").filter("FullDate = '2025-03-30'")
    assert day.count() == 23
    assert 3 not in {r.HourOfDay for r in day.collect()}


def test_hours_without_weather_or_price_stay(spark, folder):
    star = build(
        spark, folder, [(PUMP, "100", "2025-11-23 10:10:00"), (PUMP, "bad", "2025-11-23 11:10:00")],
        observed=[("sunny", "2025-11-23 10:20:00", 4.0)], prices=[("2025-11-23 12:00:00", 50)],
    )
    rows = star.fact.orderBy("TimeKey").collect()
    assert [(r.ASHP_Power, r.OutdoorTemp, r.ElectricityPrice) for r in rows] == [(100.0, 4.0, None), (None, None, None)]
    sunday = star.dim_time.first()
    assert (sunday.DayOfWeek, sunday.IsWeekend, star.dim_time.count()) == (7, True, 3)


def test_device_versions_meet_without_overlap(spark, folder):
    readings = [(PUMP, "700", t) for t in ("2024-01-31 10:00:00", "2024-02-01 10:00:00", "2023-10-14 10:00:00")]
    star = build(spark, folder, readings)
    brands = star.fact.join(star.dim_device, "DeviceKey").join(star.dim_time, "TimeKey")
    # the hour before the first installation has no device and no fact row
    assert tuples(brands.select(F.col("FullDate").cast("string"), "Brand")) == [
        ("2024-01-31", "Daikin"), ("2024-02-01", "Mitsubishi Electric"),
    ]
    below = analytics.y8a(star.fact, star.dim_time, star.dim_device)
    assert tuples(below) == [(2024, 1, 31, 1)]
    assert analytics.y8a(star.fact, star.dim_time, star.dim_device, model="Daikin_123").count() == 0


def test_only_one_sensor_leaves_the_others_null(spark):
    row = silver.stg_iot(iot(spark, [(PUMP, "5", "2025-01-01 00:10:00"), (PUMP, "7", "2025-01-01 00:50:00")])).first()
    assert row.heat_pump_power_avg == 6.0
    assert all(v is None for k, v in row.asDict().items() if k not in ("hour_start", "heat_pump_power_avg"))


def test_last_condition_skips_null(spark):
    observed = weather(
        spark, [("rain", "2025-01-01 00:10:00", 1.0), ("fog", "2025-01-01 00:20:00", 3.0), (None, "2025-01-01 00:30:00", None)]
    )
    row = silver.stg_weather(observed).first()
    assert (row.condition_state, row.temperature_c) == ("fog", 2.0)


def test_price_correction_replaces_the_earlier_one(spark):
    rows = [("2025-01-01 00:00:00", 10, "2025-01-02"), ("2025-01-01 00:00:00", 30, "2025-01-03"), ("2025-01-01 00:15:00", 50)]
    assert silver.stg_price(price(spark, rows), latest_only=True).first().price_eur_per_kwh == pytest.approx(0.04)
    assert silver.stg_price(price(spark, rows)).first().price_eur_per_kwh == pytest.approx(0.03)
    assert silver.stg_price(price(spark, rows), zone="FI").count() == 0


def test_holiday_outranks_weekend_and_repeated_holidays_do_not_multiply(spark):
    days = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 1, 1),)], "timestamp date")
    instants = spark.createDataFrame([(utc("2022-01-01 10:00:00"),)], "HourTs timestamp")
    rows = gold.dim_time(instants, days).collect()
    assert [(r.IsHoliday, r.IsWeekend, r.Season) for r in rows] == [(True, True, "Winter")]


def test_limited_view_hides_and_keeps(spark, folder):
    star = build(spark, folder, [(PUMP, "250", "2025-11-23 10:10:00"), (INDOOR, "21.5", "2025-11-23 10:20:00")])
    limited = access.limited_access(star.fact)
    row = limited.first()
    assert (row.ASHP_Power_Range, row.WC_Temp, row.ElectricityPrice_Range, row.IndoorTemp) == ("200...300", "Masked", None, 21.5)
    assert "ASHP_Power" not in limited.columns and "ElectricityPrice" not in limited.columns


def test_seeded_violations_are_found(spark, folder):
    star = build(spark, folder, [(PUMP, "-5", "2025-11-23 10:10:00"), (INDOOR, "20", "2025-11-23 11:20:00")])
    clean = star.tables()
    broken = dict(clean)
    broken["fact"] = clean["fact"].withColumn("DeviceKey", F.lit(99)).withColumn("FactKey", F.lit(1))
    found = {(r.table, r.column, r.check): r.failing for r in run_suite(broken, STAR_CHECKS).collect()}
    assert found[("fact", "DeviceKey", "relationships")] == 2
    assert found[("fact", "FactKey", "unique")] == 1
    assert found[("fact", "ASHP_Power", "ASHP_Power >= 0")] == 1  # a NULL power passes this one
    assert found[("fact", "ASHP_Power", "not_null")] == 1
    assert found[("fact", "TimeKey", "relationships")] == 0
    assert all(r.failing == 0 for r in run_suite({"dim_device": clean["dim_device"]}, DIAGRAM_CHECKS[:1]).collect())
    assert {r.check: r.failing for r in run_suite(clean, GOVERNANCE_CHECKS).collect()} == {
        "not_null": 0, "unique": 0, "ASHP_Power BETWEEN 0 AND 10000": 1,
    }


def test_check_prefixes_the_column(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "n int")
    rows = run_suite({"t": df}, [Check("t", "n", "expression", ">= 0")]).collect()
    assert rows[0].failing == 1
