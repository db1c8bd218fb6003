"""Operators that replace a single-task or all-pairs plan: results and plans."""

import datetime as dt

import pytest
from helpers import iot, tuples, utc
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.operators import aggregates, joins, keys
from hearth.plans import exploration
from hearth.sizing import fits

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(spark):
    day = dt.date.fromisoformat
    rows = [
        (1, "a", day("2023-12-01"), day("2024-01-10")),
        (1, "b", day("2024-01-11"), day("9999-12-31")),
        (2, "c", day("2024-01-05"), day("2024-01-05")),
        (2, "d", day("2024-01-20"), day("2024-01-19")),  # empty interval
        (2, "e", None, day("2024-01-30")),
        (3, "f", day("2020-01-01"), day("9999-12-31")),
    ]
    return spark.createDataFrame(rows, "key int, name string, since date, until date")


def facts(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(-60, 400)]
    # key 1 holds most of the rows
    return spark.createDataFrame(
        [(i, 1 if i % 3 else i % 4, d) for i, d in enumerate(days)], "id int, k int, day date"
    )


@pytest.mark.parametrize("bucket_days", [1, 7, 32, 1000])
def test_bucketed_validity_join_equals_the_plain_condition(spark, bucket_days):
    fact, dim = facts(spark), versions(spark)
    brute = fact.join(
        dim, (F.col("k") == F.col("key")) & F.col("day").between(F.col("since"), F.col("until"))
    ).select("id", "k", "day", "name")
    options = dict(carry=["name"], keys=[("k", "key")], bucket_days=bucket_days)
    broadcast = joins.validity_join(fact, dim, "day", "since", "until", **options)
    shuffled = joins.validity_join_bucketed(fact, dim, "day", "since", "until", **options)
    assert tuples(brute) == tuples(broadcast) == tuples(shuffled)
    assert "BroadcastHashJoin" in plan_of(broadcast)
    assert "SortMergeJoin" in plan_of(shuffled)
    assert "NestedLoop" not in plan_of(broadcast) + plan_of(shuffled)


def test_validity_join_without_keys_switches_at_its_size_limit(spark):
    fact, dim = facts(spark), versions(spark)
    small = joins.validity_join(fact, dim, "day", "since", "until", carry=["name"])
    large = joins.validity_join(fact, dim, "day", "since", "until", carry=["name"], max_rows=3)
    assert tuples(small) == tuples(large)
    assert "SortMergeJoin" in plan_of(large) and "Cartesian" not in plan_of(large)


def test_overlapping_versions_equals_cross_join(spark):
    dim = versions(spark)
    left = dim.select(F.col("name").alias("l"), "since", "until")
    right = dim.select(F.col("name").alias("r"), F.col("since").alias("s"), F.col("until").alias("u"))
    days = facts(spark).select("day")
    brute = (
        days.distinct().crossJoin(left).crossJoin(right)
        .filter("day between since and until and day between s and u")
        .groupBy("l", "r").agg(F.count("*").alias("days"))
    )
    assert tuples(joins.overlapping_versions(left, right, days)) == tuples(brute)


def test_global_row_number_is_dense_and_ordered(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    # one leading value holds a third of the rows
    skewed = lines.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 3 == 0, F.lit("same")).otherwise(F.col("l_shipdate").cast("string")))
    order = skewed.columns
    numbered = keys.global_row_number(skewed, order, "k", partitions=7)
    expected = skewed.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint")).select("k", *order)
    assert tuples(numbered) == tuples(expected)


def test_global_row_number_of_nothing(spark):
    assert keys.global_row_number(spark.range(0).toDF("x"), ["x"], "k").count() == 0


def test_surrogate_key_is_the_same_on_both_paths(spark):
    parts = spark.read.parquet(f"{SF}/part.parquet").select("p_brand", "p_partkey")
    order = ["p_brand", "p_partkey"]
    assert tuples(keys.surrogate_key(parts, order, "k")) == tuples(keys.surrogate_key(parts, order, "k", max_rows=10))


def test_calendar_row_number_spans_months(spark):
    hours = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 7200 + 1_700_000_000).alias("ts"))
    rows = keys.calendar_row_number(hours, "ts", "k").orderBy("ts").collect()
    assert [r.k for r in rows] == list(range(1, 2001))


def test_fits_counts_no_further_than_its_limit(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10)


def test_latest_per_key_settles_ties(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    assert tuples(aggregates.latest_per_key(df, ["k"], "v")) == [("a", 2, "z"), ("b", None, "w")]


def test_wide_table_keeps_repeated_timestamps(spark):
    a, b = "sensor.ohksoojus_power", "sensor.0xa4c138cdc6eff777_power"
    columns = {a: "pump", b: "boiler"}
    once = iot(spark, [(a, "1", "2025-01-01 00:00:00"), (b, "2", "2025-01-01 00:00:00"), (b, "3", "2025-01-01 01:00:00")])
    assert tuples(exploration.wide_raw(once, columns)) == tuples(exploration.merge_sensors(once, columns))
    twice = once.unionByName(iot(spark, [(a, "9", "2025-01-01 00:00:00")]))
    # the second reading gets a row of its own; nothing multiplies
    assert tuples(exploration.wide_raw(twice, columns)) == [
        (utc("2025-01-01 00:00:00"), "1", "2"),
        (utc("2025-01-01 00:00:00"), "9", None),
        (utc("2025-01-01 01:00:00"), None, "3"),
    ]


def test_wide_table_never_outgrows_the_log(spark):
    sensors = ["sensor.ohksoojus_power", "sensor.0xa4c138cdc6eff777_power", "sensor.ohukuivati_power"]
    columns = dict(zip(sensors, ["pump", "boiler", "drier"]))
    log = iot(spark, [(s, str(i % 9), "2025-01-01 00:00:00") for s in sensors for i in range(40)])
    wide = exploration.wide_raw(log, columns)
    assert wide.count() == 40
    readings = [r[name] for r in wide.collect() for name in columns.values()]
    assert sorted(readings) == sorted(r.state for r in log.collect())


def test_rows_without_a_key_stay_and_do_not_multiply(spark):
    left = spark.createDataFrame([(None, 1), (None, 5), ("a", 2)], "t string, l int")
    right = spark.createDataFrame([(None, 3), (None, 6), ("b", 4)], "t string, r int")
    assert tuples(joins.outer_merge([left, right], "t")) == [
        ("a", 2, None), ("b", None, 4), (None, 1, None), (None, 5, None), (None, None, 3), (None, None, 6),
    ]
    a, b = "sensor.ohksoojus_power", "sensor.0xa4c138cdc6eff777_power"
    rows = iot(spark, [(a, "1", None), (b, "2", None), (a, "3", "2025-01-01 00:00:00")])
    columns = {a: "pump", b: "boiler"}
    assert tuples(exploration.wide_raw(rows, columns)) == tuples(exploration.merge_sensors(rows, columns))


def test_global_row_number_splits_equal_rows(spark, folder):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(-1)).alias("x"))
    numbered = keys.global_row_number(rows, ["x"], "k", partitions=8, stage_path=folder, unique=False)
    assert [r.k for r in numbered.orderBy("k").collect()] == list(range(1, 3001))
    assert [r.x for r in numbered.orderBy("k").collect()] == sorted(r.x for r in rows.collect())
    sizes = spark.read.parquet(folder).groupBy(F.shiftright("_slot", 33)).count().agg(F.max("count")).first()[0]
    assert sizes < 1000  # the third that is equal does not sit in one partition


def test_hourly_weather_scans_once_with_hash_aggregation(spark):
    from hearth.plans.silver import stg_weather
    from workbench import feeds

    plan = plan_of(stg_weather(feeds.weather(spark, SF)))
    assert plan.count("FileScan") == 1
    below_first_shuffle = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below_first_shuffle and "SortAggregate" not in below_first_shuffle


def test_questions_read_only_the_columns_they_need(spark):
    from hearth.plans import analytics
    from workbench import marts

    star = marts.star(spark, SF)
    plan = plan_of(analytics.y1a(star.fact, star.dim_time, star.dim_device))
    assert "OutdoorTemp" in plan and "WindDir" not in plan
    pushed = [line for line in plan.splitlines() if "ReadSchema" in line and "OutdoorTemp" in line]
    assert pushed and all("PushedFilters: [IsNotNull" in line for line in pushed)


def numbered_plainly(df, names, order):
    others = [c for c in df.columns if c not in [*names, *order]]
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*order, *others)) - 1
    return df.withColumn("n", place.cast("bigint"))


@pytest.mark.parametrize("copies", [1, 3, 100_000])
def test_numbers_go_on_across_partitions(spark, monkeypatch, copies):
    """A key over all partitions, keys that end where one ends, equal rows in any number."""
    monkeypatch.setattr(keys, "COPIES", copies)
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    try:
        base = spark.range(1500)
        hot = base.select(F.lit("hot").alias("k"), (F.col("id") % 400).alias("v"), (F.col("id") % 2).alias("w"))
        some = base.select(F.concat(F.lit("k"), F.col("id") % 11).alias("k"), F.col("id").alias("v"), F.lit(1).cast("bigint").alias("w"))
        same = spark.range(700).select(F.lit("same").alias("k"), F.lit(None).cast("bigint").alias("v"), F.lit(5).cast("bigint").alias("w"))
        single = spark.range(50).select(F.concat(F.lit("s"), F.col("id")).alias("k"), F.col("id").alias("v"), F.col("id").alias("w"))
        rows = hot.unionByName(some).unionByName(same).unionByName(single)
        found = keys.repeat_number(rows, ["k"], ["v"], "n")
        assert found.columns == ["k", "v", "w", "n"]
        assert tuples(found) == tuples(numbered_plainly(rows, ["k"], ["v"]))
        assert keys.repeat_number(rows.limit(0), ["k"], ["v"], "n").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_numbering_writes_once(spark, folder):
    rows = spark.range(1000).select((F.col("id") % 10).alias("x"), (F.col("id") % 100).alias("y"))
    numbered = keys.global_row_number(rows, ["x"], "k", stage_path=f"{folder}/slots", unique=False)
    expected = rows.withColumn("k", F.row_number().over(Window.orderBy("x", "y")).cast("bigint")).select("k", "x", "y")
    assert tuples(numbered) == tuples(expected)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    assert [f.getPath().getName() for f in listed] == ["slots"]
    # equal rows are one row of it
    assert spark.read.parquet(f"{folder}/slots").count() == 100


def test_wide_table_with_a_hot_timestamp(spark):
    sensors = ["sensor.ohksoojus_power", "sensor.0xa4c138cdc6eff777_power"]
    columns = dict(zip(sensors, ["pump", "boiler"]))
    rows = [(sensors[0], str(i % 7), "2025-01-01 00:00:00") for i in range(300)] + [(sensors[1], str(i), "2025-01-01 00:00:00") for i in range(20)]
    rows += [(s, str(i), f"2025-01-02 {i:02}:00:00") for s in sensors for i in range(20)]
    wide = exploration.wide_raw(iot(spark, rows), columns)
    assert wide.count() == 300 + 20
    pumps = sorted(str(i % 7) for i in range(300))
    boilers = sorted(str(i) for i in range(20))
    expected = [(utc("2025-01-01 00:00:00"), p, boilers[i] if i < 20 else None) for i, p in enumerate(pumps)]
    expected += [(utc(f"2025-01-02 {i:02}:00:00"), str(i), str(i)) for i in range(20)]
    assert tuples(wide) == sorted(expected, key=repr)
