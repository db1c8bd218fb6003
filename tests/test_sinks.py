"""Interval replacement and the other write modes."""

import pytest
from helpers import executions, price, tuples, utc
from pyspark.sql import functions as F

from hearth import sinks
from hearth.schemas import BRONZE_PRICE
from hearth.session import release, shared_dir
from hearth.sources import read_or_empty, read_price_table


def stored(spark, folder):
    return [(r.ts_utc, r.price_per_mwh) for r in read_price_table(spark, folder).orderBy("ts_utc", "price_per_mwh").collect()]


HISTORY = [("2025-01-01 23:00:00", 1), ("2025-01-02 00:00:00", 2), ("2025-01-02 12:00:00", 3), ("2025-01-03 00:00:00", 4)]


@pytest.fixture()
def table(spark, folder):
    sinks.write_day_partitioned(price(spark, HISTORY), folder, "ts_utc")
    return folder


def test_replacing_twice_equals_once(spark, table):
    batch = price(spark, [("2025-01-02 00:00:00", 20), ("2025-01-02 06:00:00", 25)])
    for _ in range(2):
        assert sinks.replace_interval(batch, table, "ts_utc", "2025-01-02 00:00:00", "2025-01-02 12:00:00")
        assert stored(spark, table) == [
            (utc("2025-01-01 23:00:00"), 1.0), (utc("2025-01-02 00:00:00"), 20.0), (utc("2025-01-02 06:00:00"), 25.0),
            (utc("2025-01-02 12:00:00"), 3.0), (utc("2025-01-03 00:00:00"), 4.0),
        ]


def test_empty_batch_changes_nothing(spark, table):
    before = stored(spark, table)
    assert not sinks.replace_interval(price(spark, []), table, "ts_utc", "2025-01-01", "2025-01-04")
    assert stored(spark, table) == before


def test_first_write_creates_the_table(spark, folder):
    sinks.replace_interval(price(spark, HISTORY), folder, "ts_utc", "2025-01-01", "2025-01-04")
    assert len(stored(spark, folder)) == 4


def test_rows_outside_the_interval_are_appended_only(spark, table):
    batch = price(spark, [("2025-01-02 00:00:00", 20), ("2025-01-01 05:00:00", 9)])
    sinks.replace_interval(batch, table, "ts_utc", "2025-01-02 00:00:00", "2025-01-02 01:00:00")
    assert [p for _, p in stored(spark, table)] == [9.0, 1.0, 20.0, 3.0, 4.0]


def test_cleared_day_disappears(spark, table):
    sinks.clear_range(spark, table, BRONZE_PRICE, "ts_utc", "2025-01-02", "2025-01-03")
    assert [p for _, p in stored(spark, table)] == [1.0, 4.0]
    days = sinks.read_days(spark, table, BRONZE_PRICE).select("ts_day").distinct().count()
    assert days == 2


def test_clearing_everything_leaves_an_empty_table(spark, table):
    sinks.clear_range(spark, table, BRONZE_PRICE, "ts_utc", "2024-01-01", "2026-01-01")
    assert stored(spark, table) == []


def test_rows_without_a_time_are_refused(spark, table):
    from pyspark.sql import functions as F

    batch = price(spark, [("2025-01-02 00:00:00", 1)]).withColumn("ts_utc", F.lit(None).cast("timestamp"))
    with pytest.raises(ValueError, match="fit no interval"):
        sinks.replace_interval(batch, table, "ts_utc", "2025-01-02", "2025-01-03")
    assert len(stored(spark, table)) == 4


def test_backfill_end_is_exclusive_and_boundary_copies_count_once(spark, table):
    batch = price(spark, [("2025-01-01 00:00:00", 7), ("2025-01-02 00:00:00", 8), ("2025-01-02 00:00:00", 8)])
    sinks.replace_range_backfill(batch, table, "ts_utc", "2025-01-01", "2025-01-03", ["zone", "ts_utc"])
    assert [p for _, p in stored(spark, table)] == [7.0, 8.0, 4.0]


def test_upsert_keeps_other_rows_of_the_day(spark, table):
    for _ in range(2):
        sinks.upsert_rows(price(spark, [("2025-01-02 12:00:00", 33), ("2025-01-05 00:00:00", 5)]), table, "ts_utc", ["zone", "ts_utc"])
    assert [p for _, p in stored(spark, table)] == [1.0, 2.0, 33.0, 4.0, 5.0]


def test_missing_path_reads_as_empty_with_schema(spark, folder):
    empty = read_or_empty(spark, folder, BRONZE_PRICE)
    assert empty.count() == 0 and empty.schema == BRONZE_PRICE


def test_write_modes(spark, folder):
    first, second = price(spark, HISTORY[:1]), price(spark, HISTORY[1:])
    sinks.create_if_absent(first, folder)
    sinks.create_if_absent(second, folder)
    assert tuples(read_price_table(spark, folder)) == tuples(first)
    sinks.append(second, folder)
    assert read_price_table(spark, folder).count() == 4
    sinks.overwrite(second, folder)
    assert read_price_table(spark, folder).count() == 3


def test_clustered_files_do_not_overlap(spark, folder):
    from pyspark.sql import functions as F

    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_custkey", "o_orderkey")
    sinks.write_clustered(orders, folder, ["o_custkey", "o_orderkey"])
    files = spark.read.parquet(folder).groupBy(F.input_file_name()).agg(
        F.min(F.struct("o_custkey", "o_orderkey")).alias("lo"), F.max(F.struct("o_custkey", "o_orderkey")).alias("hi")
    ).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")


def test_interrupted_change_is_completed_by_the_next_write(spark, table, monkeypatch):
    """The job dies after a day folder was removed and before its new one is in place."""
    swap = sinks._swap

    def dies(content, path, emptied):
        sinks._drop_day(spark, path, utc("2025-01-02").date())
        raise RuntimeError("lost driver")

    monkeypatch.setattr(sinks, "_swap", dies)
    batch = price(spark, [("2025-01-02 00:00:00", 20)])
    with pytest.raises(RuntimeError):
        sinks.replace_interval(batch, table, "ts_utc", "2025-01-02 00:00:00", "2025-01-02 01:00:00")
    assert [p for _, p in stored(spark, table)] == [1.0, 4.0]
    monkeypatch.setattr(sinks, "_swap", swap)
    sinks.replace_interval(price(spark, [("2025-01-03 00:00:00", 40)]), table, "ts_utc", "2025-01-03", "2025-01-04")
    assert [p for _, p in stored(spark, table)] == [1.0, 20.0, 3.0, 40.0]


def test_day_filter_prunes_partitions(spark, table):
    from hearth.operators.filters import time_window

    rows = time_window(
        sinks.read_days(spark, table, BRONZE_PRICE), "ts_utc", "2025-01-02", "2025-01-03", day="ts_day"
    )
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_day" in plan
    assert [r.price_per_mwh for r in rows.orderBy("ts_utc").collect()] == [2.0, 3.0]


def test_recursive_price_files(spark, folder):
    price(spark, HISTORY[:2]).write.parquet(f"{folder}/data/a/b")
    price(spark, HISTORY[2:]).write.parquet(f"{folder}/data/c")
    assert read_price_table(spark, f"{folder}/data", recursive=True).count() == 4


def folders(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def test_failed_swap_survives_release(spark, tmp_path, monkeypatch):
    """Staged rows lie beside the table, so cleaning the scratch tree does not lose them."""
    table = f"{tmp_path}/prices"
    sinks.write_day_partitioned(price(spark, HISTORY), table, "ts_utc")
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            sinks.replace_interval(price(spark, [("2025-01-02 00:00:00", 20)]), table, "ts_utc", "2025-01-02", "2025-01-03")
    assert len(folders(spark, f"{table}_staging")) == 1
    release(spark)
    sinks.replace_interval(price(spark, [("2025-01-03 00:00:00", 40)]), table, "ts_utc", "2025-01-03", "2025-01-04")
    assert [p for _, p in stored(spark, table)] == [1.0, 20.0, 40.0]
    assert folders(spark, str(tmp_path)) == ["prices"]


def test_writes_leave_no_staging(spark, tmp_path):
    table = f"{tmp_path}/prices"
    batch = price(spark, HISTORY)
    sinks.replace_interval(batch, table, "ts_utc", "2025-01-01", "2025-01-04")
    sinks.replace_interval(batch.limit(0), table, "ts_utc", "2025-01-01", "2025-01-04")
    sinks.upsert_rows(batch, table, "ts_utc", ["zone", "ts_utc"])
    sinks.clear_range(spark, table, BRONZE_PRICE, "ts_utc", "2025-01-02", "2025-01-03")
    with pytest.raises(ValueError):
        sinks.replace_interval(batch.selectExpr("* EXCEPT (ts_utc)", "CAST(NULL AS TIMESTAMP) AS ts_utc"), table, "ts_utc", "2025-01-02", "2025-01-03")
    assert folders(spark, str(tmp_path)) == ["prices"]


def test_newest_version_of_a_key_is_kept(spark, table):
    versions = [("2025-01-02 00:00:00", p, t) for p, t in ((5, "2025-02-01"), (7, "2025-02-03"), (6, "2025-02-02"), (4, "2025-02-03"))]
    batch = price(spark, versions)
    sinks.replace_range_backfill(batch, table, "ts_utc", "2025-01-02", "2025-01-03", ["zone", "ts_utc"])
    assert [p for _, p in stored(spark, table)] == [1.0, 7.0, 4.0]
    sinks.upsert_rows(price(spark, [(a, p + 1, t) for a, p, t in versions]), table, "ts_utc", ["zone", "ts_utc"])
    assert [p for _, p in stored(spark, table)] == [1.0, 8.0, 4.0]


def test_touched_days_are_literals(spark, table):
    import datetime as dt

    rows = sinks.read_days(spark, table, BRONZE_PRICE).filter(sinks.on_days([dt.date(2025, 1, 2)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_day" in plan and "(ts_day#" in plan and "= 2025-01-02)" in plan
    assert sinks.read_days(spark, table, BRONZE_PRICE).filter(sinks.on_days([])).count() == 0


def rows_scanned(spark, df):
    """Rows that the file scans of ``df`` hand on, by the metrics of its run."""
    found, store = executions(spark, lambda: df.write.format("noop").mode("overwrite").save())
    last = found[-1]
    values = store.executionMetrics(last.executionId())
    graph = store.planGraph(last.executionId()).allNodes()
    total = 0
    for i in range(graph.size()):
        node = graph.apply(i)
        if node.name().startswith("Scan parquet"):
            metrics = node.metrics()
            for j in range(metrics.size()):
                if metrics.apply(j).name() == "number of output rows":
                    total += int(values.apply(metrics.apply(j).accumulatorId()).replace(",", ""))
    return total


def test_bloom_filters_skip_row_groups_that_min_and_max_do_not(spark, folder):
    """An entity that is absent, but lies inside the range of every row group."""
    log = spark.range(200_000).select(
        F.concat(F.lit("sensor."), F.sha2(F.concat((F.col("id") * 7919 % 200_000).cast("string"), F.lit("x")), 256)).alias("entity_id"),
        (F.col("id") % 1000).alias("at"),
    )
    sinks.write_clustered(log, f"{folder}/plain", ["at"])
    sinks.write_clustered(log, f"{folder}/bloom", ["at"], bloom={"entity_id": 200_000})
    absent = "sensor.7fffffffffffffff"
    found = {}
    for name in ("plain", "bloom"):
        stored = spark.read.schema(log.schema).parquet(f"{folder}/{name}")
        assert stored.count() == 200_000
        found[name] = rows_scanned(spark, stored.filter(F.col("entity_id") == absent))
        present = stored.orderBy("entity_id").first()["entity_id"]
        assert stored.filter(F.col("entity_id") == present).count() == 1
    assert found["plain"] == 200_000 and found["bloom"] == 0


def test_upsert_of_null_keys(spark, folder):
    rows = price(spark, [("2025-01-02 12:00:00", 1)]).withColumn("currency", F.lit(None).cast("string"))
    for _ in range(2):
        sinks.upsert_rows(rows, folder, "ts_utc", ["zone", "ts_utc", "currency"])
    assert [p for _, p in stored(spark, folder)] == [1.0]


def test_a_first_upsert_stages_its_rows_once(spark, folder, monkeypatch):
    paths, staged = [], sinks._staged
    monkeypatch.setattr(sinks, "_staged", lambda df, path: paths.append(path) or staged(df, path))
    sinks.upsert_rows(price(spark, [("2025-01-02 12:00:00", 1)]), folder, "ts_utc", ["zone", "ts_utc"])
    assert len(paths) == 1
    sinks.upsert_rows(price(spark, [("2025-01-02 12:00:00", 2), ("2025-01-02 13:00:00", 3)]), folder, "ts_utc", ["zone", "ts_utc"])
    assert [p for _, p in stored(spark, folder)] == [2.0, 3.0]
