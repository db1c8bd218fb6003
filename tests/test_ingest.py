"""Interval runs and backfills from landed payloads to tested models."""

import json
import re

import pytest
from helpers import devices, executions, iot, locations, tuples, utc

from hearth import sinks
from hearth.plans import gold, ingest
from hearth.plans.calendar import holidays
from hearth.plans.silver import stg_iot
from hearth.plans.star import read_star, register_star
from hearth.schemas import SENSOR_COLUMNS
from hearth.sources import bad_documents, read_bronze, read_price
from hearth.sources.registry import bronze_path

PUMP = "sensor.ohksoojus_power"
START, END = "2025-11-23 10:00:00", "2025-11-23 11:00:00"


def land(spark, path, *documents):
    spark.createDataFrame([(json.dumps(d),) for d in documents], "value string").write.mode("append").text(path)
    return path


@pytest.fixture()
def root(spark, folder):
    sinks.overwrite(devices(spark), bronze_path(f"{folder}/bronze", "bronze_device"))
    sinks.overwrite(locations(spark), bronze_path(f"{folder}/bronze", "bronze_location"))
    return folder


def state(entity, value, at):
    return {"entity_id": entity, "state": value, "last_changed": at, "attributes": {}}


def landing(spark, root):
    inside = [state(PUMP, "100", "2025-11-23T10:10:00Z"), state(PUMP, "300", "2025-11-23T10:40:00Z")]
    outside = [state(PUMP, "999", "2025-11-23T11:00:00Z"), state("sensor.other", "5", "2025-11-23T10:10:00Z")]
    weather = state("weather.forecast_home", "rain", "2025-11-23T10:30:00Z") | {"attributes": {"temperature": 2}}
    return ingest.Landing(
        history=land(spark, f"{root}/history", [inside, outside]),
        weather=land(spark, f"{root}/weather", [[weather]]),
        prices=land(spark, f"{root}/prices", {"success": True, "data": {"ee": [{"timestamp": 1763892000, "price": 80}]}}),
    )


def test_interval_run_is_repeatable(spark, root):
    landed = landing(spark, root)
    for _ in range(2):
        star, report = ingest.run(
            spark, f"{root}/bronze", landed, START, END, holidays=holidays(spark, 2020, 2040), marts=f"{root}/marts"
        )
    # the reading that landed for the next hour is kept, once
    assert star.fact.count() == 2
    row = star.fact.orderBy("TimeKey").first()
    assert (row.ASHP_Power, row.OutdoorTemp, row.ElectricityPrice, row.WeatherCondition) == (200.0, 2.0, 0.08, "rain")
    assert report.filter("failing > 0").count() == 0
    assert read_bronze(spark, f"{root}/bronze", ingest.IOT).count() == 3
    assert tuples(read_star(spark, f"{root}/marts").fact) == tuples(star.fact)


def test_sql_over_registered_views(spark, root):
    star, _ = ingest.run(
        spark, f"{root}/bronze", landing(spark, root), START, END,
        holidays=holidays(spark, 2020, 2040), marts=f"{root}/marts",
    )
    register_star(star)
    answer = spark.sql(
        """SELECT CASE WHEN t.IsWeekend THEN 'weekend' ELSE 'weekday' END AS kind,
                  SUM(f.ASHP_Power / 1000 * f.ElectricityPrice) AS cost
           FROM FACT_HEATING_ENERGY_USAGE f JOIN DIM_TIME t ON f.TimeKey = t.TimeKey
           JOIN dim_device d ON d.DeviceKey = f.DeviceKey WHERE d.Brand = 'Daikin' GROUP BY 1"""
    ).first()
    assert (answer.kind, answer.cost) == ("weekend", pytest.approx(0.016))
    masked = spark.sql("SELECT ASHP_Power_Range, WC_Temp FROM v_heating_energy_limited_access ORDER BY TimeKey").first()
    assert tuple(masked) == ("200...300", "Masked")
    assert spark.sql("SELECT * FROM v_heating_energy_full_access").count() == 2


def test_backfill_prefers_statistics_and_falls_back_to_history(spark, root):
    hourly = {"hourly": {"time": ["2025-11-23T10:00", "2025-11-23T11:00"], "temperature_2m": [1.0, 2.0]}}
    history = land(spark, f"{root}/history", [[state(PUMP, "100", "2025-11-23T10:10:00Z")]])
    options = dict(
        prices=land(spark, f"{root}/prices", {"success": False}),
        weather=land(spark, f"{root}/hourly", hourly),
        history=history,
    )
    filled = land(spark, f"{root}/statistics", {PUMP: [{"start": 1763892000000, "mean": 55}]})
    empty = land(spark, f"{root}/no-statistics", {PUMP: []})
    ingest.load_range(spark, f"{root}/bronze", ingest.Landing(statistics=filled, **options), "2025-11-23", END)
    assert [r.state for r in read_bronze(spark, f"{root}/bronze", ingest.IOT).collect()] == ["55"]
    ingest.load_range(spark, f"{root}/bronze", ingest.Landing(statistics=empty, **options), "2025-11-23", END)
    assert [r.state for r in read_bronze(spark, f"{root}/bronze", ingest.IOT).collect()] == ["100"]
    # the hour at the exclusive end is left to the hourly load
    assert [r.last_changed for r in read_bronze(spark, f"{root}/bronze", ingest.WEATHER).collect()] == [utc(START)]


def test_cutoff(spark):
    row = spark.range(1).select(ingest.cutoff("2025-11-05 10:40:00").alias("c")).first()
    assert row.c == utc("2025-11-05 09:00:00")


def test_one_broken_document_stops_the_load(spark, root):
    landed = landing(spark, root)
    ingest.load_interval(spark, f"{root}/bronze", landed, START, END)
    before = {name: tuples(read_bronze(spark, f"{root}/bronze", name)) for name in (ingest.IOT, ingest.WEATHER, ingest.PRICE)}
    good = {"success": True, "data": {"ee": [{"timestamp": 1763892000, "price": 1}]}}
    prices = land(spark, f"{root}/prices-2", good)
    spark.createDataFrame([(json.dumps(good)[:40],), ("  ",)], "value string").write.mode("append").text(prices)
    broken = ingest.Landing(history=landed.history, weather=landed.weather, prices=prices)
    with pytest.raises(Exception, match="broken document"):
        ingest.load_interval(spark, f"{root}/bronze", broken, START, END)
    assert tuples(read_bronze(spark, f"{root}/bronze", ingest.PRICE)) == before[ingest.PRICE]
    assert bad_documents(spark, prices, "price").count() == 1
    assert read_price(spark, prices, broken="skip").count() == 1


def test_load_report(spark, root):
    told = ingest.load_interval(spark, f"{root}/bronze", landing(spark, root), START, END)
    assert told[ingest.IOT] == ingest.Loaded(True, inside=2, elsewhere=1, untimed=0)
    assert told[ingest.PRICE] == ingest.Loaded(True, 1, 0, 0)


def test_backfill_report(spark, root):
    hourly = {"hourly": {"time": ["2025-11-23T10:00", "2025-11-23T11:00", "2025-11-23T12:00"], "temperature_2m": [1.0, 2.0, 3.0]}}
    landed = ingest.Landing(
        statistics=land(spark, f"{root}/statistics", {PUMP: [{"start": 1763892000000, "mean": 55}]}),
        prices=land(spark, f"{root}/prices", {"success": False}),
        weather=land(spark, f"{root}/hourly", hourly),
    )
    told = ingest.load_range(spark, f"{root}/bronze", landed, "2025-11-23", END)
    assert told[ingest.WEATHER].skipped == 2 and told[ingest.WEATHER].inside == 1
    assert PUMP not in told[ingest.IOT].missing and len(told[ingest.IOT].missing) == len(SENSOR_COLUMNS) - 1
    assert not told[ingest.PRICE].changed


def landing_scans(spark, job, *folders):
    """How often ``job`` scans each landing folder, by the executed plans of the session."""
    plans = [one.physicalPlanDescription() for one in executions(spark, job)[0]]
    final = [re.split("== Initial Plan ==", plan)[0].split("\n\n\n")[-1] for plan in plans]
    return {f: sum(f"{f}]" in part for plan in final for part in re.findall(r"Location:.*", plan)) for f in folders}


def test_an_interval_parses_each_log_once(spark, root):
    """Rows inside, elsewhere and without a time, all told from one scan of each landing folder."""
    landed = landing(spark, root)
    land(spark, landed.history, [[state(PUMP, "1", None), state(PUMP, "7", "2025-11-20T05:00:00Z")]])
    told = {}
    folders = [landed.history, landed.weather, landed.prices]
    scans = landing_scans(spark, lambda: told.update(ingest.load_interval(spark, f"{root}/bronze", landed, START, END)), *folders)
    assert scans == dict.fromkeys(folders, 1)
    assert told[ingest.IOT] == ingest.Loaded(True, inside=2, elsewhere=2, untimed=1)
    assert {str(day) for day in told[ingest.IOT].days} == {"2025-11-20", "2025-11-23"}
    assert told[ingest.WEATHER] == told[ingest.PRICE] == ingest.Loaded(True, 1, 0, 0)
    assert no_staging(spark, f"{root}/bronze")


def test_a_backfill_parses_each_log_once(spark, root):
    hourly = {"hourly": {"time": [f"2025-11-{d}T10:00" for d in (21, 22, 23, 24, 25)], "temperature_2m": [1.0] * 5}}
    prices = [{"timestamp": 1763892000 + 86400 * i, "price": i} for i in (-2, -1, 0, 1)]
    landed = ingest.Landing(
        statistics=land(spark, f"{root}/statistics", {PUMP: [{"start": "2025-11-19T00:00:00Z", "mean": 5}]}),
        history=land(spark, f"{root}/history", [[state(PUMP, "100", "2025-11-22T10:10:00Z"), state(PUMP, "9", None)]]),
        prices=land(spark, f"{root}/prices", {"success": True, "data": {"ee": prices}}),
        weather=land(spark, f"{root}/hourly", hourly),
    )
    told = {}
    folders = [landed.statistics, landed.history, landed.prices, landed.weather]
    job = lambda: told.update(ingest.load_range(spark, f"{root}/bronze", landed, "2025-11-22", "2025-11-24"))
    assert landing_scans(spark, job, *folders) == dict.fromkeys(folders, 1)
    missing = tuple(sorted(set(SENSOR_COLUMNS) - {PUMP}))
    assert told[ingest.IOT] == ingest.Loaded(True, 1, 0, 0, missing=missing)
    assert told[ingest.PRICE] == ingest.Loaded(True, inside=2, elsewhere=2, untimed=0)
    assert told[ingest.WEATHER] == ingest.Loaded(True, inside=2, elsewhere=1, untimed=0, skipped=2)
    assert no_staging(spark, f"{root}/bronze")


def no_staging(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return not [f.getPath().getName() for f in found if f.getPath().getName().endswith(("_staging", "_pending"))]


def test_a_load_that_fails_leaves_no_staged_rows(spark, root):
    landed = landing(spark, root)
    spark.createDataFrame([("{",)], "value string").write.mode("append").text(landed.prices)
    with pytest.raises(Exception, match="broken document"):
        ingest.load_interval(spark, f"{root}/bronze", landed, START, END)
    assert no_staging(spark, f"{root}/bronze")


def test_dead_build_leaves_the_star_before_it(spark, root, monkeypatch):
    options = dict(holidays=holidays(spark, 2020, 2040), marts=f"{root}/marts")
    ingest.run(spark, f"{root}/bronze", landing(spark, root), START, END, **options)
    before = tuples(read_star(spark, f"{root}/marts").fact)

    def dies(**inputs):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(gold, "fact_energy", dies)
        with pytest.raises(RuntimeError):
            ingest.rebuild(spark, f"{root}/bronze", **options)
    old = read_star(spark, f"{root}/marts")
    assert tuples(old.fact) == before
    assert old.fact.join(old.dim_time, "TimeKey").count() == len(before)
    for _ in range(3):
        ingest.rebuild(spark, f"{root}/bronze", **options)
    assert tuples(read_star(spark, f"{root}/marts").fact) == before
    # the current build and the one before it are all that is left
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/marts/versions")
    assert len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)) == 2


def test_replay_of_half_hours_recomputes_whole_ones(spark, root):
    log = iot(spark, [(PUMP, "100", "2025-01-02 00:10:00"), (PUMP, "300", "2025-01-02 01:10:00"), (PUMP, "500", "2025-01-02 01:50:00")])
    bronze, hourly = f"{root}/replay-bronze", f"{root}/replay-hourly"
    sinks.write_day_partitioned(log, bronze, "last_changed")
    sinks.write_day_partitioned(stg_iot(log), hourly, "hour_start")
    late = iot(spark, [(PUMP, "200", "2025-01-02 00:40:00")])
    stored = ingest.late_replay(late, bronze, hourly, "2025-01-02 00:30:00", "2025-01-02 01:30:00")
    found = [(r.hour_start, r.heat_pump_power_avg) for r in stored.orderBy("hour_start").collect()]
    assert found == [(utc("2025-01-02 00:00:00"), 150.0), (utc("2025-01-02 01:00:00"), 500.0)]


def test_two_intervals_equal_one_full_build(spark, root):
    options = dict(holidays=holidays(spark, 2020, 2040), marts=f"{root}/marts")
    landed = landing(spark, root)
    next_hour = [state(PUMP, "700", "2025-11-23T11:20:00Z"), state(PUMP, "50", "2025-11-20T05:00:00Z")]
    later = ingest.Landing(
        history=land(spark, f"{root}/history-2", [next_hour]), weather=land(spark, f"{root}/weather-2", [[]]),
        prices=land(spark, f"{root}/prices-2", {"success": True, "data": {"ee": [{"timestamp": 1763895600, "price": 90}]}}),
    )
    ingest.run(spark, f"{root}/bronze", landed, START, END, **options)
    step, _ = ingest.run(spark, f"{root}/bronze", later, END, "2025-11-23 12:00:00", **options)
    full, _ = ingest.rebuild(spark, f"{root}/bronze", holidays=options["holidays"], marts=f"{root}/full")
    for name in ("stg_iot", "stg_weather", "stg_price", "dim_time", "fact"):
        assert tuples(getattr(step, name)) == tuples(getattr(full, name)), name
    assert step.fact.count() == 3


def test_only_touched_days_are_staged(spark, root, monkeypatch):
    ingest.run(spark, f"{root}/bronze", landing(spark, root), START, END, holidays=holidays(spark, 2020, 2040), marts=f"{root}/marts")
    plans = []
    name, model, hour, schema = ingest.STAGING[ingest.IOT]

    def spied(log):
        plans.append(log._jdf.queryExecution().executedPlan().toString())
        return model(log)

    monkeypatch.setitem(ingest.STAGING, ingest.IOT, (name, spied, hour, schema))
    ingest._restage(spark, f"{root}/bronze", f"{root}/marts", ingest.IOT, (utc("2025-11-23").date(),))
    assert "PartitionFilters: [isnotnull(ts_day" in plans[0] and "2025-11-23" in plans[0]
