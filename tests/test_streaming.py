"""Streams against their batch counterparts, late rows and replays."""

from helpers import iot, tuples, utc, weather
from pyspark.sql import functions as F

from hearth import sinks, streaming
from hearth.operators.aggregates import latest_in_group
from hearth.functions.time import hour_start
from hearth.plans.ingest import late_replay, replay_late
from hearth.plans.silver import stg_iot
from hearth.schemas import BRONZE_IOT, BRONZE_WEATHER

PUMP = "sensor.ohksoojus_power"


def land(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def hourly(spark, table):
    rows = spark.read.parquet(table).orderBy("hour_start").collect()
    return {r.hour_start: r.heat_pump_power_avg for r in rows}


def drain_hourly(spark, folder):
    stream = streaming.hourly_wide_stream(streaming.stream_readings(spark, f"{folder}/in", files_per_trigger=1), "1 hour")
    streaming.drain(stream, streaming.upsert_result_sink(f"{folder}/out"), f"{folder}/checkpoint")


def test_hourly_averages_over_several_runs_and_a_late_row(spark, folder):
    land(iot(spark, [(PUMP, "10", "2025-01-01 10:05:00")]), f"{folder}/in")
    drain_hourly(spark, folder)
    land(iot(spark, [(PUMP, "20", "2025-01-01 10:30:00"), (PUMP, "1", "2025-01-01 13:00:00")]), f"{folder}/in")
    drain_hourly(spark, folder)
    assert hourly(spark, f"{folder}/out") == {utc("2025-01-01 10:00:00"): 15.0, utc("2025-01-01 13:00:00"): 1.0}
    # the watermark is at 12:00 now, so this one comes too late for the stream
    late = iot(spark, [(PUMP, "90", "2025-01-01 10:45:00")])
    land(late, f"{folder}/in")
    drain_hourly(spark, folder)
    assert hourly(spark, f"{folder}/out")[utc("2025-01-01 10:00:00")] == 15.0
    # replaying the closed hour from bronze brings it in
    readings = spark.read.schema(BRONZE_IOT).parquet(f"{folder}/in")
    window = ("2025-01-01 10:00:00", "2025-01-01 11:00:00")
    batch = readings.filter(F.col("last_changed").between(*[F.lit(w).cast("timestamp") for w in window]))
    late_replay(batch, f"{folder}/bronze", f"{folder}/out", *window)
    assert hourly(spark, f"{folder}/out") == {utc("2025-01-01 10:00:00"): 40.0, utc("2025-01-01 13:00:00"): 1.0}


def test_stream_equals_batch(spark, folder):
    from workbench import feeds

    readings = feeds.readings(spark, "/root/testdata/sf0.001")
    land(readings, f"{folder}/in")
    drain_hourly(spark, folder)
    columns = stg_iot(readings).columns
    streamed = spark.read.parquet(f"{folder}/out").select(*columns)
    assert tuples(streamed) == tuples(stg_iot(readings))


def test_repeated_delivery_counts_once(spark, folder):
    rows = [(PUMP, "10", "2025-01-01 10:05:00"), (PUMP, "10", "2025-01-01 10:05:00"), (PUMP, "11", "2025-01-01 10:06:00")]
    land(iot(spark, rows), f"{folder}/in")
    land(iot(spark, rows[:1]), f"{folder}/in")
    stream = streaming.dedup_stream(streaming.stream_readings(spark, f"{folder}/in", files_per_trigger=1), "1 hour")
    streaming.drain(stream, streaming.append_sink(f"{folder}/out"), f"{folder}/checkpoint", mode="append")
    assert sorted(r.state for r in spark.read.schema(BRONZE_IOT).parquet(f"{folder}/out").collect()) == ["10", "11"]


def test_replayed_batch_changes_nothing(spark, folder):
    batch = iot(spark, [(PUMP, "1", "2025-01-01 10:00:00"), (PUMP, "2", "2025-01-02 10:00:00")])
    sink = streaming.upsert_interval_sink(folder, "last_changed", ["entity_id", "last_changed"])
    sink(batch, 0)
    once = tuples(sinks.read_days(spark, folder, BRONZE_IOT))
    sink(batch, 0)
    assert tuples(sinks.read_days(spark, folder, BRONZE_IOT)) == once
    sink(iot(spark, [(PUMP, "3", "2025-01-01 10:30:00")]), 1)
    assert sinks.read_days(spark, folder, BRONZE_IOT).count() == 3


def test_last_state_ignores_null(spark, folder):
    land(weather(spark, [("rain", "2025-01-01 10:05:00", 1.0), (None, "2025-01-01 10:50:00", 1.0)]), f"{folder}/in")
    observed = streaming.stream_readings(spark, f"{folder}/in", schema=BRONZE_WEATHER)
    stream = streaming.last_state_stream(observed, "1 hour")
    streaming.drain(stream, streaming.upsert_result_sink(f"{folder}/out"), f"{folder}/checkpoint")
    assert spark.read.parquet(f"{folder}/out").first().condition_state == "rain"


DELIVERIES = [
    [(PUMP, "10", "2025-01-01 10:05:00"), (PUMP, "12", "2025-01-01 11:50:00")],
    [(PUMP, "20", "2025-01-01 10:30:00"), (PUMP, "1", "2025-01-01 15:00:00"), (PUMP, "x", None)],
    # the watermark is at 13:00 now: the first two come too late, the third does not
    [(PUMP, "90", "2025-01-01 10:45:00"), (PUMP, "30", "2025-01-01 08:00:00"), (PUMP, "40", "2025-01-01 13:10:00")],
    [(PUMP, "2", "2025-01-02 00:30:00")],
    [(PUMP, "7", "2025-01-01 13:20:00"), (PUMP, "90", "2025-01-01 10:45:00")],
]


def admit(spark, folder, by="hour", schema=BRONZE_IOT):
    """One micro-batch per delivered file, as it would be if each had landed alone."""
    raw = streaming.stream_readings(spark, f"{folder}/in", schema=schema, files_per_trigger=1)
    streaming.drain(raw, streaming.admit_sink(f"{folder}/admit", "last_changed", "2 hours", by=by), f"{folder}/admit-checkpoint", mode="append")
    return streaming.stream_accepted(spark, f"{folder}/admit", schema)


def test_late_rows_are_kept_and_replayed(spark, folder):
    for delivery in DELIVERIES:
        land(iot(spark, delivery), f"{folder}/in")
        accepted = admit(spark, folder)
        streaming.drain(accepted, streaming.upsert_interval_sink(f"{folder}/bronze", "last_changed", ["entity_id", "last_changed"]), f"{folder}/c1")
        streaming.drain(streaming.hourly_wide_stream(accepted, "2 hours"), streaming.upsert_result_sink(f"{folder}/out"), f"{folder}/c2")
    late = streaming.late_rows(spark, f"{folder}/admit", BRONZE_IOT, "last_changed")
    assert [(r.state, str(r.late_hour)) for r in late.orderBy("late_hour", "state").collect()] == [
        ("30", "2025-01-01 08:00:00"), ("90", "2025-01-01 10:00:00"), ("90", "2025-01-01 10:00:00"), ("7", "2025-01-01 13:00:00"),
    ]
    # on time were all rows that the stateful query counted, and it lost none of them
    on_time = spark.read.option("recursiveFileLookup", True).schema(BRONZE_IOT).parquet(f"{folder}/admit/accepted")
    columns = stg_iot(on_time).columns
    assert tuples(spark.read.parquet(f"{folder}/out").select(*columns)) == tuples(stg_iot(on_time))
    options = dict(bronze=f"{folder}/bronze", hourly=f"{folder}/out")
    assert replay_late(spark, f"{folder}/admit", BRONZE_IOT, "last_changed", ["entity_id", "last_changed"], **options) == 4
    everything = iot(spark, [row for delivery in DELIVERIES[:4] for row in delivery] + DELIVERIES[4][:1])
    assert tuples(spark.read.parquet(f"{folder}/out").select(*columns)) == tuples(stg_iot(everything))
    assert replay_late(spark, f"{folder}/admit", BRONZE_IOT, "last_changed", ["entity_id", "last_changed"], **options) == 0
    # a later delivery adds to what was replayed
    land(iot(spark, [(PUMP, "50", "2025-01-01 08:30:00")]), f"{folder}/in")
    admit(spark, folder)
    assert replay_late(spark, f"{folder}/admit", BRONZE_IOT, "last_changed", ["entity_id", "last_changed"], **options) == 1
    assert hourly(spark, f"{folder}/out")[utc("2025-01-01 08:00:00")] == 40.0


def test_late_rows_of_a_deduplicated_stream(spark, folder):
    table, keys = f"{folder}/table", ["entity_id", "last_changed"]
    for delivery in DELIVERIES:
        land(iot(spark, delivery), f"{folder}/in")
        deduped = streaming.dedup_stream(admit(spark, folder, by="row"), "2 hours")
        streaming.drain(deduped, streaming.upsert_interval_sink(table, "last_changed", keys), f"{folder}/c", mode="append")
    replay_late(spark, f"{folder}/admit", BRONZE_IOT, "last_changed", keys, table)
    rows = iot(spark, [row for delivery in DELIVERIES for row in delivery if row[2]]).dropDuplicates(keys).select("state", *keys)
    assert tuples(sinks.read_days(spark, table, BRONZE_IOT).filter("last_changed IS NOT NULL").select("state", *keys)) == tuples(rows)


def test_late_rows_of_last_states(spark, folder):
    deliveries = [
        [("rain", "2025-01-01 10:05:00", 1.0), ("sun", "2025-01-01 16:00:00", 1.0)],
        [("fog", "2025-01-01 10:50:00", 1.0), ("wind", "2025-01-01 16:30:00", 1.0)],
        [(None, "2025-01-01 10:59:00", 1.0)],
    ]
    for delivery in deliveries:
        land(weather(spark, delivery), f"{folder}/in")
        accepted = admit(spark, folder, schema=BRONZE_WEATHER)
        streaming.drain(accepted, streaming.upsert_interval_sink(f"{folder}/bronze", "last_changed", ["entity_id", "last_changed"]), f"{folder}/c1")
        streaming.drain(streaming.last_state_stream(accepted, "2 hours"), streaming.upsert_result_sink(f"{folder}/out"), f"{folder}/c2")
    before = {r.hour_start.hour: r.condition_state for r in spark.read.parquet(f"{folder}/out").collect()}
    assert before == {10: "rain", 16: "wind"}

    def model(rows):
        return latest_in_group(rows, {"hour_start": hour_start(F.col("last_changed"))}, "condition_state", "last_changed")

    replay_late(
        spark, f"{folder}/admit", BRONZE_WEATHER, "last_changed", ["entity_id", "last_changed"], f"{folder}/bronze",
        hourly=f"{folder}/out", model=model,
    )
    assert {r.hour_start.hour: r.condition_state for r in spark.read.parquet(f"{folder}/out").collect()} == {10: "fog", 16: "wind"}


def test_an_admission_run_again_publishes_nothing_new(spark, folder):
    sink = streaming.admit_sink(folder, "last_changed", "2 hours")
    first, second = iot(spark, DELIVERIES[1]), iot(spark, DELIVERIES[2])
    sink(first, 0)
    sink(second, 1)
    accepted = f"{folder}/accepted"
    listed = sorted(spark.read.option("recursiveFileLookup", True).schema(BRONZE_IOT).parquet(accepted).inputFiles())
    for batch, number in ((second, 1), (first, 0), (second, 1)):
        sink(batch, number)
    assert sorted(spark.read.option("recursiveFileLookup", True).schema(BRONZE_IOT).parquet(accepted).inputFiles()) == listed
    assert streaming.late_rows(spark, folder, BRONZE_IOT, "last_changed").count() == 2
    # an empty batch, and one without any time
    sink(iot(spark, []), 2)
    sink(iot(spark, [(PUMP, "1", None)]), 3)
    assert streaming.late_rows(spark, folder, BRONZE_IOT, "last_changed").count() == 2
    for number in range(4, 30):
        sink(iot(spark, []), number)
    sink(iot(spark, [(PUMP, "1", "2025-01-01 10:00:00")]), 30)
    assert streaming.late_rows(spark, folder, BRONZE_IOT, "last_changed").count() == 3


def test_last_states_from_times(spark, folder):
    """The same as one aggregation of texts, over several deliveries, without a sort in the plan."""
    deliveries = [
        [("rain", "2025-01-01 10:05:00", 1.0), (None, "2025-01-01 10:50:00", 1.0), (None, "2025-01-01 11:50:00", 1.0)],
        [("fog", "2025-01-01 10:40:00", 1.0), ("rain", "2025-01-01 10:20:00", 1.0), ("sun", "2025-01-01 12:00:00", 1.0)],
        [("rain", "2025-01-01 10:40:00", 1.0), ("a", "2025-01-01 12:00:00", 1.0)],
    ]
    plans = []
    for delivery in deliveries:
        land(weather(spark, delivery), f"{folder}/in")
        observed = streaming.stream_readings(spark, f"{folder}/in", schema=BRONZE_WEATHER)
        stream = streaming.state_times_stream(observed, "2 hours")
        sink = streaming.last_state_sink(f"{folder}/out")

        def spied(batch, number, sink=sink):
            plans.append(batch._jdf.queryExecution().toString())
            sink(batch, number)

        query = streaming.drain(stream, spied, f"{folder}/checkpoint")
        plans.append(query._jsq.explainInternal(False))
    found = {r.hour_start.hour: r.condition_state for r in spark.read.parquet(f"{folder}/out").collect()}
    assert found == {10: "rain", 12: "sun"}
    assert any("HashAggregate" in plan for plan in plans) and not any("SortAggregate" in plan for plan in plans)
    batch = spark.read.schema(BRONZE_WEATHER).parquet(f"{folder}/in").filter("condition_state IS NOT NULL")
    model = latest_in_group(batch, {"hour_start": hour_start(F.col("last_changed"))}, "condition_state", "last_changed")
    assert {r.hour_start.hour: r.condition_state for r in model.collect()} == found
