"""Streams of landed payloads, and enrichment while the star is rebuilt."""

import json

import pytest
from helpers import build, iot, tuples, utc
from pyspark.sql import functions as F

from hearth import sinks, sources, streaming
from hearth.plans import star as stars
from hearth.plans.calendar import holidays
from hearth.schemas import BRONZE_IOT, BRONZE_PRICE

PUMP = "sensor.ohksoojus_power"
KEYS = ["entity_id", "last_changed"]


def state(entity, value, at):
    return {"entity_id": entity, "state": value, "last_changed": at, "attributes": {"u": "W"}}


def land(spark, folder, *texts):
    rows = [(t if isinstance(t, str) else json.dumps(t),) for t in texts]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(folder)


def drain(spark, folder, kind="history", ts="last_changed", keys=KEYS, **options):
    sink = streaming.payload_sink(kind, f"{folder}/table", ts, keys, f"{folder}/quarantine", **options)
    documents = streaming.stream_documents(spark, f"{folder}/in", files_per_trigger=1)
    streaming.drain(documents, sink, f"{folder}/checkpoint", mode="append")


def test_good_and_broken_documents_land(spark, folder):
    good = [[state(PUMP, "1", "2025-01-01T10:00:00Z"), state("b", "x", "2025-01-02T00:00:00+02:00")], []]
    land(spark, f"{folder}/in", good, "[[", "null", "  ", [[state(PUMP, "9", None)]])
    drain(spark, folder)
    land(spark, f"{folder}/in", [[state(PUMP, "2", "2025-01-01T10:00:00Z"), state("c", "3", "2025-01-01T11:00:00Z")]], "{}")
    drain(spark, folder)
    rows = sinks.read_days(spark, f"{folder}/table", BRONZE_IOT)
    assert sorted((r.entity_id, r.state, r.last_changed, r.attributes) for r in rows.collect()) == [
        ("b", "x", utc("2025-01-01 22:00:00"), '{"u":"W"}'), ("c", "3", utc("2025-01-01 11:00:00"), '{"u":"W"}'),
        (PUMP, "2", utc("2025-01-01 10:00:00"), '{"u":"W"}'),
    ]
    broken = streaming.quarantined(spark, f"{folder}/quarantine", "documents", "value string")
    assert sorted(r.value for r in broken.collect()) == ["[[", "null", "{}"]
    untimed = streaming.quarantined(spark, f"{folder}/quarantine", "untimed", BRONZE_IOT)
    assert [r.state for r in untimed.collect()] == ["9"]
    # as the batch reader takes them, but for versions and rows without a time
    batch = sources.read_iot_history(spark, f"{folder}/in", broken="skip").filter("last_changed IS NOT NULL AND state <> '1'")
    assert tuples(rows.select("state", *KEYS)) == tuples(batch.select("state", *KEYS))


def test_a_batch_run_again_adds_nothing(spark, folder):
    texts = [json.dumps([[state(PUMP, "1", "2025-01-01T10:00:00Z"), state(PUMP, "4", None)]]), "broken", "[]"]
    batch = spark.createDataFrame([(t,) for t in texts], "value string")
    sink = streaming.payload_sink("history", f"{folder}/table", "last_changed", KEYS, f"{folder}/quarantine")
    for _ in range(2):
        sink(batch, 7)
    assert sinks.read_days(spark, f"{folder}/table", BRONZE_IOT).count() == 1
    assert streaming.quarantined(spark, f"{folder}/quarantine", "documents", "value string").count() == 1
    assert streaming.quarantined(spark, f"{folder}/quarantine", "untimed", BRONZE_IOT).count() == 1
    sink(spark.createDataFrame([], "value string"), 8)
    assert sinks.read_days(spark, f"{folder}/table", BRONZE_IOT).count() == 1


def test_prices_and_filters(spark, folder):
    zoneless = {"success": True, "data": {"lv": [{"timestamp": 1, "price": 1}]}}
    good = {"success": True, "data": {"ee": [{"timestamp": 1763892000, "price": 80}, {"timestamp": 1763895600, "price": -1}]}}
    land(spark, f"{folder}/in", good, zoneless, {"success": False})
    drain(spark, folder, "price", "ts_utc", ["zone", "ts_utc"], keep=lambda rows: rows.filter("price_per_mwh > 0"))
    rows = sinks.read_days(spark, f"{folder}/table", BRONZE_PRICE).collect()
    assert [(r.zone, r.ts_utc, r.price_per_mwh) for r in rows] == [("EE", utc("2025-11-23 10:00:00"), 80.0)]
    broken = streaming.quarantined(spark, f"{folder}/quarantine", "documents", "value string").collect()
    assert [json.loads(r.value) for r in broken] == [zoneless]


def star_of(spark, folder, brand):
    rows = [(brand, "M", 1.0, 2.0, utc("2023-01-01").date(), utc("9999-12-31").date())]
    return build(spark, folder, [(PUMP, "1", "2025-01-01 10:00:00")], device_rows=rows)


def test_enrichment_over_rebuilds(spark, folder):
    """A stream that goes on over three rebuilds, each of which would delete the star before it."""
    marts, seen = f"{folder}/marts", []

    def rebuilding(batch, batch_id):
        for step in range(3):  # while this batch holds its star
            star_of(spark, marts, f"brand {batch_id}.{step}")
        seen.append((batch_id, sorted(r.Brand for r in batch.collect())))

    star_of(spark, marts, "first")
    readings = iot(spark, [(PUMP, str(i), f"2025-01-0{i} 10:00:00") for i in (1, 2, 3)])
    for day in (1, 2, 3):
        readings.filter(F.dayofmonth("last_changed") == day).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    rows = streaming.stream_readings(spark, f"{folder}/in", files_per_trigger=1)
    sink = streaming.enrich_sink(marts, "enrichment", holidays(spark, 2024, 2026), "last_changed", rebuilding)
    streaming.drain(rows, sink, f"{folder}/checkpoint", mode="append")
    assert seen == [(0, ["first"]), (1, ["brand 0.2"]), (2, ["brand 1.2"])]
    assert len(stars.published(spark, marts)) >= 2
    star_of(spark, marts, "last")
    assert len(stars.published(spark, marts)) == 2  # no pin is left


def test_pins(spark, folder):
    with pytest.raises(FileNotFoundError):
        stars.pin(spark, folder, "reader")
    star_of(spark, folder, "one")
    first = stars.pin(spark, folder, "reader")
    for name in ("two", "three", "four"):
        star_of(spark, folder, name)
    assert first in stars.published(spark, folder) and len(stars.published(spark, folder)) == 3
    assert stars.read_star(spark, folder, first).dim_device.first().Brand == "one"
    assert stars.read_star(spark, folder).dim_device.first().Brand == "four"
    # a reader of the same name takes over, another keeps its own
    stars.pin(spark, folder, "other", first)
    newest = stars.pin(spark, folder, "reader")
    assert newest == stars.published(spark, folder)[-1]
    star_of(spark, folder, "five")
    assert first in stars.published(spark, folder)
    stars.unpin(spark, folder, "other")
    star_of(spark, folder, "six")
    assert first not in stars.published(spark, folder) and newest in stars.published(spark, folder)
    with pytest.raises(FileNotFoundError):
        stars.pin(spark, folder, "other", first)
    with pytest.raises(ValueError):
        stars.pin(spark, folder, "a/b")
