"""Surrogate keys that stay when rows arrive late."""

import json

import pytest
from helpers import devices, locations, tuples, utc
from pyspark.sql import functions as F

from hearth import sinks
from hearth.operators import key_registry
from hearth.operators.key_registry import read_registry, stable_key
from hearth.paths import names
from hearth.plans import gold, ingest
from hearth.plans.calendar import holidays
from hearth.plans.star import assemble_star, read_star
from hearth.sources.registry import bronze_path

PUMP = "sensor.ohksoojus_power"


def frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, other string")


def test_new_keys_follow_and_old_ones_stay(spark, folder):
    first = [("b", 1, "x"), ("a", None, "y"), (None, 2, "z"), ("b", 1, "again")]
    found = stable_key(frame(spark, first), ["a", "b"], "k", folder)
    assert found.columns == ["k", "a", "b", "other"]
    assert tuples(found) == sorted([(1, None, 2, "z"), (2, "a", None, "y"), (3, "b", 1, "x"), (3, "b", 1, "again")], key=repr)
    later = [("a", 0, "new"), ("b", 1, "old"), (None, None, "new"), (None, 2, "old")]
    for _ in range(2):  # the second time nothing is new
        found = stable_key(frame(spark, later), ["a", "b"], "k", folder)
        assert tuples(found) == sorted([(5, "a", 0, "new"), (3, "b", 1, "old"), (4, None, None, "new"), (1, None, 2, "old")], key=repr)
    assert stable_key(frame(spark, []), ["a", "b"], "k", folder).count() == 0
    assert names(spark, f"{folder}/parts") == [f"{1:020d}-{3:020d}", f"{4:020d}-{5:020d}"]
    assert names(spark, folder) == ["parts"]


def test_many_parts_become_one(spark, folder, monkeypatch):
    monkeypatch.setattr(key_registry, "MANY_PARTS", 3)
    schema = key_registry._schema(frame(spark, []), ["a"], "k")
    for i in range(9):
        stable_key(frame(spark, [(f"key {9 - i}", i, "x")]), ["a"], "k", folder)
    assert len(names(spark, f"{folder}/parts")) <= 4
    assert tuples(read_registry(spark, folder, schema)) == sorted(((f"key {9 - i}", i + 1) for i in range(9)), key=repr)
    # parts that a compaction did not come to delete are not read
    whole = read_registry(spark, folder, schema)
    whole.filter("k = 2").write.parquet(f"{folder}/parts/{2:020d}-{2:020d}")
    assert read_registry(spark, folder, schema).count() == 9


def test_a_writer_that_died_has_added_nothing(spark, folder, monkeypatch):
    stable_key(frame(spark, [("a", 1, "x")]), ["a"], "k", folder)
    with monkeypatch.context() as patch:
        patch.setattr(key_registry, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            stable_key(frame(spark, [("0", 1, "x")]), ["a"], "k", folder)
    found = stable_key(frame(spark, [("0", 1, "x"), ("00", 1, "x")]), ["a"], "k", folder)
    assert sorted((r.a, r.k) for r in found.collect()) == [("0", 2), ("00", 3)]


def land(spark, path, *documents):
    spark.createDataFrame([(json.dumps(d),) for d in documents], "value string").write.mode("append").text(path)
    return path


def hour(spark, root, number, *times):
    """A landing of its own with pump readings at the given times."""
    states = [{"entity_id": PUMP, "state": str(i + 1), "last_changed": at, "attributes": {}} for i, at in enumerate(times)]
    return ingest.Landing(
        history=land(spark, f"{root}/history-{number}", [states]), weather=land(spark, f"{root}/weather-{number}", [[]]),
        prices=land(spark, f"{root}/prices-{number}", {"success": True, "data": {"ee": [{"timestamp": 1763892000 + 3600 * number, "price": 5}]}}),
    )


def with_hours(star):
    return star.fact.join(star.dim_time.select("TimeKey", "HourTs"), "TimeKey").drop("TimeKey", "FactKey")


def test_a_late_hour_changes_no_key(spark, folder):
    sinks.overwrite(devices(spark), bronze_path(f"{folder}/bronze", "bronze_device"))
    sinks.overwrite(locations(spark), bronze_path(f"{folder}/bronze", "bronze_location"))
    options = dict(holidays=holidays(spark, 2020, 2040), marts=f"{folder}/marts", stable_keys=True)
    loads = [
        (hour(spark, folder, 0, "2025-11-23T10:10:00Z", "2025-11-23T10:40:00Z"), "2025-11-23 10:00:00", "2025-11-23 11:00:00"),
        # the next hour, with a reading of days before
        (hour(spark, folder, 1, "2025-11-23T11:10:00Z", "2025-11-20T05:30:00Z"), "2025-11-23 11:00:00", "2025-11-23 12:00:00"),
        # the same hour again, with other readings
        (hour(spark, folder, 2, "2025-11-23T11:50:00Z", "2024-02-10T00:00:00Z"), "2025-11-23 11:00:00", "2025-11-23 12:00:00"),
    ]
    keys: dict = {}
    for landed, start, end in loads:
        star, report = ingest.run(spark, f"{folder}/bronze", landed, start, end, **options)
        assert report.filter("failing > 0").count() == 0
        now = {r.HourTs: (r.TimeKey, r.FactKey) for r in star.dim_time.join(star.fact, "TimeKey", "left").collect()}
        assert {h: now[h][0] for h in keys} == {h: k[0] for h, k in keys.items()}
        assert all(now[h][1] == k[1] for h, k in keys.items() if k[1] is not None)
        keys = now
    late = {str(h): k for h, k in keys.items()}
    assert late["2025-11-20 05:00:00"][0] > late["2025-11-23 10:00:00"][0]
    # as a build of everything, but for the numbers
    full, _ = ingest.rebuild(spark, f"{folder}/bronze", holidays=options["holidays"], marts=f"{folder}/full")
    assert tuples(with_hours(star).drop("DeviceKey", "LocationKey")) == tuples(with_hours(full).drop("DeviceKey", "LocationKey"))
    assert star.fact.count() == 4 and star.fact.select("FactKey").distinct().count() == 4


def test_only_touched_hours_are_computed(spark, folder, monkeypatch):
    """Untouched facts are taken over; a changed dimension has all of them made anew."""
    sinks.overwrite(devices(spark), bronze_path(f"{folder}/bronze", "bronze_device"))
    sinks.overwrite(locations(spark), bronze_path(f"{folder}/bronze", "bronze_location"))
    options = dict(holidays=holidays(spark, 2020, 2040), marts=f"{folder}/marts", stable_keys=True)
    computed, model = [], gold.fact_energy

    def spied(**inputs):
        computed.append(sorted(str(r.hour_start) for r in inputs["stg_iot"].select("hour_start").collect()))
        return model(**inputs)

    monkeypatch.setattr(gold, "fact_energy", spied)
    ingest.run(spark, f"{folder}/bronze", hour(spark, folder, 0, "2025-11-21T10:10:00Z"), "2025-11-21 10:00:00", "2025-11-21 11:00:00", **options)
    ingest.run(spark, f"{folder}/bronze", hour(spark, folder, 1, "2025-11-25T11:10:00Z"), "2025-11-25 11:00:00", "2025-11-25 12:00:00", **options)
    assert computed[1] == ["2025-11-25 11:00:00"]
    more = devices(spark).filter("Brand <> 'Daikin'").withColumn("Brand", F.lit("Another"))
    sinks.overwrite(devices(spark).unionByName(more), bronze_path(f"{folder}/bronze", "bronze_device"))
    star, _ = ingest.run(spark, f"{folder}/bronze", hour(spark, folder, 2, "2025-11-26T11:10:00Z"), "2025-11-26 11:00:00", "2025-11-26 12:00:00", **options)
    assert len(computed[2]) == 3 and star.fact.count() == 3
    assert tuples(read_star(spark, f"{folder}/marts").fact) == tuples(star.fact)
    with pytest.raises(ValueError):
        assemble_star(
            stg_iot=star.stg_iot, stg_weather=star.stg_weather, stg_price=star.stg_price, bronze_device=devices(spark),
            bronze_location=locations(spark), holidays=options["holidays"], root=folder, touched=[utc("2025-11-26").date()],
        )
