"""Payload shapes that land from the services."""

import json

import pytest
from helpers import utc
from pyspark.sql import functions as F

from hearth import sources
from hearth.sources.registry import read_bronze


def land(spark, folder, *documents):
    spark.createDataFrame([(json.dumps(d),) for d in documents], "value string").write.text(folder)
    return folder


def test_history_lists(spark, folder):
    land(
        spark, folder,
        [[{"entity_id": "a", "state": "1", "last_changed": "2025-01-01T02:00:00+02:00", "attributes": {"u": "W"}}],
         [{"entity_id": "b", "state": "x", "last_changed": None}, {"entity_id": "b", "state": "y"}]],
        [],
    )
    rows = sources.read_iot_history(spark, folder).orderBy("entity_id", "state").collect()
    assert [(r.entity_id, r.state, r.last_changed, r.attributes) for r in rows] == [
        ("a", "1", utc("2025-01-01 00:00:00"), '{"u":"W"}'), ("b", "x", None, "{}"), ("b", "y", None, "{}"),
    ]


def test_pretty_printed_file(spark, folder):
    text = json.dumps([[{"entity_id": "a", "state": "1", "last_changed": "2025-01-01T00:00:00Z"}]], indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)
    assert sources.read_iot_history(spark, folder, per="file").count() == 1


def test_weather_attributes(spark, folder):
    attributes = {"temperature": 3, "pressure": "1000.5", "humidity": "n/a", "wind_speed": None, "uv_index": " 2 "}
    land(spark, folder, [[{"entity_id": "w", "state": "rain", "last_changed": "2025-01-01T00:00:00Z", "attributes": attributes}]])
    row = sources.read_weather_history(spark, folder).first()
    assert (row.temperature_C, row.pressure_hPa, row.humidity_percent, row.wind_speed_kmh, row.uv_index, row.dew_point_C) == (
        3.0, 1000.5, None, None, 2.0, None,
    )


def test_price_payloads(spark, folder):
    good = {"success": True, "data": {"ee": [{"timestamp": 1761955200, "price": -1.5}], "lv": [{"timestamp": 1, "price": 9}]}}
    land(spark, folder, good, {"success": False, "data": {"ee": [{"timestamp": 1, "price": 1}]}}, {"success": True, "data": {}}, {"success": True})
    rows = sources.read_price(spark, folder).collect()
    assert [(r.ts_utc, r.zone, r.currency, r.price_per_mwh) for r in rows] == [(utc("2025-11-01"), "EE", "EUR", -1.5)]
    assert sources.read_price(spark, folder, zone="lv").first().price_per_mwh == 9.0


REFUSED = {
    "history": ["null", "[[]", '[[]],"b":[]', "[]}", "[],[]", '{"a":1}', "3"],
    "weather": ["null", "[[]]}{"],
    "price": [
        "null", "[]", '{"success":true},"b":{"c":1}', '{"success":true}}', '{"success":true,"data":{"lv":[]}}',
        '{"success":true,"data":{"ee":null}}', '{"success":true,"data":{"ee":3}}',
    ],
    "statistics": ["null", "[]", '{},"x":{}'],
    "hourly": ["null", "[]", '{"hourly":{}},"x":1'],
}
TAKEN = {
    "history": ["[]", "[[]]", " [ ] "], "weather": ["[]"], "statistics": ["{}"], "hourly": ["{}", '{"hourly":null}'],
    "price": ["{}", '{"success":false}', '{"success":true}', '{"success":true,"data":null}', '{"success":true,"data":{}}',
              '{"success":null,"data":{"lv":[]}}', '{"success":true,"data":{"ee":[]}}', '{"success":true,"data":{"lv":[],"ee":[]}}'],
}


@pytest.mark.parametrize("kind", REFUSED)
def test_what_is_no_document_is_refused(spark, folder, kind):
    """Broken, null, more than one value in a text, or without what its shape must have."""
    texts = [(text,) for text in REFUSED[kind] + TAKEN[kind] + ["", "  "]]
    spark.createDataFrame(texts, "value string").write.text(folder)
    found = sorted(r.value for r in sources.bad_documents(spark, folder, kind).collect())
    assert found == sorted(REFUSED[kind])


def test_price_without_its_zone_fails_the_read(spark, folder):
    good = {"success": True, "data": {"ee": [{"timestamp": 1761955200, "price": 2}]}}
    land(spark, folder, good, {"success": True, "data": {"lv": []}})
    with pytest.raises(Exception, match="broken document"):
        sources.read_price(spark, folder).collect()
    assert sources.read_price(spark, folder, broken="skip").count() == 1
    with pytest.raises(Exception, match="broken document"):
        sources.read_price(spark, folder, zone="lv").collect()


def test_statistics_state_preference(spark, folder):
    land(spark, folder, {"a": [
        {"start": 1761955200000, "mean": 0, "state": 5}, {"start": 1761955200, "mean": None, "state": 7.5},
        {"start": "2025-11-01T00:00:00Z"}, {"start": None, "mean": 1}, {"start": "later", "mean": 1},
    ]})
    rows = sources.read_statistics(spark, folder).collect()
    assert sorted(r.state for r in rows) == ["", "0", "7.5"]
    assert {r.last_changed for r in rows} == {utc("2025-11-01")}
    one = json.loads([r.attributes for r in rows if r.state == "7.5"][0])
    assert one == {"mean": None, "min": None, "max": None, "sum": None, "state": 7.5, "source": "long_term_statistics"}


def test_short_and_missing_hourly_arrays(spark, folder):
    land(spark, folder, {"hourly": {
        "time": ["2025-01-01T00:00", "2025-01-01T01:00", "2025-01-01T02:00"], "temperature_2m": [1.0, None, 3.0],
        "shortwave_radiation": [62.5, None], "surface_pressure": [1, 2, 3, 4],
    }})
    rows = sources.read_hourly_weather(spark, folder, F.lit("2025-01-01 02:00:00").cast("timestamp")).orderBy("last_changed").collect()
    assert [(r.last_changed.hour, r.temperature_C, r.uv_index, r.pressure_hPa, r.dew_point_C, r.condition_state) for r in rows] == [
        (0, 1.0, 2.0, 1.0, None, "unknown"), (1, None, None, 2.0, None, "unknown"),
    ]


def test_unlanded_bronze_is_empty(spark, folder):
    assert read_bronze(spark, folder, "bronze_price").count() == 0


def test_csv_columns_by_name(spark, folder):
    from hearth.schemas import BRONZE_DEVICE

    names = BRONZE_DEVICE.names
    row = {"Brand": 'Quote "A", B', "Model": "two\nlines", "MinPower": "1.5", "MaxPower": "2", "InstallationDate": "2024-01-01", "ValidTo": "2024-12-31"}
    frame = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"`{n}` string" for n in names))
    expected = None
    for order in (names, list(reversed(names)), [names[1], "Extra", *[n for n in names if n != names[1]]]):
        path = f"{folder}/{'-'.join(order[:2])}"
        from pyspark.sql import functions as F

        from hearth.sinks import save_csv

        save_csv(frame.withColumn("Extra", F.lit("x")).select(*order), path)
        rows = [tuple(r) for r in sources.read_scd_csv(spark, path, BRONZE_DEVICE).collect()]
        expected = expected or rows
        assert rows == expected and rows[0][names.index("Brand")] == row["Brand"]
        assert rows[0][names.index("Model")] == row["Model"]
    save_csv(frame.drop("Brand"), f"{folder}/missing")
    with pytest.raises(ValueError, match="no column Brand"):
        sources.read_scd_csv(spark, f"{folder}/missing", BRONZE_DEVICE)
