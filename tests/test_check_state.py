"""Check results kept by day against the full suite."""

import datetime as dt
import random

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from hearth import sinks
from hearth.operators import check_state
from hearth.operators.quality import Check, run_suite
from hearth.paths import names

SCHEMA = "k int, v double, p int, ts timestamp"
CHECKS = [
    Check("t", "k", "unique"),
    Check("t", "p", "unique"),
    Check("t", "v", "not_null"),
    Check("t", "v", "expression", "v >= 0"),
    Check("t", "p", "relationships", parent="parent", parent_key="id"),
]


def day(i):
    return dt.date(2025, 1, 1) + dt.timedelta(days=i)


def rows_of(rng, i):
    at = dt.datetime.combine(day(i), dt.time(5))
    return [(rng.choice([None, *range(30)]), rng.choice([None, -1.0, 1.0]), rng.choice([None, 1, 2, 3, 99 + i]), at) for _ in range(rng.randint(0, 12))]


def full(spark, table, parent):
    return tuples(run_suite({"t": table, "parent": parent}, CHECKS))


def test_updates_equal_the_full_suite(spark, folder):
    rng = random.Random(4)
    path, state = f"{folder}/table", f"{folder}/state"
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    content = {i: rows_of(rng, i) for i in range(4)}
    sinks.write_day_partitioned(spark.createDataFrame([r for rows in content.values() for r in rows], SCHEMA), path, "ts")
    schema = spark.createDataFrame([], SCHEMA).schema
    table = lambda: sinks.read_days(spark, path, schema)
    check_state.update_checks(table(), CHECKS, state, [day(i) for i in range(4)], {"parent": parent})
    assert tuples(check_state.read_checks(spark, "t", CHECKS, state)) == full(spark, table(), parent)
    for changed in ([1], [0, 3], [5]):
        for i in changed:
            content[i] = [] if i == 3 else rows_of(rng, i)
            sinks.replace_days(spark.createDataFrame(content[i], SCHEMA), path, "ts", [day(i)])
        check_state.update_checks(table(), CHECKS, state, [day(i) for i in changed], {"parent": parent})
        assert tuples(check_state.read_checks(spark, "t", CHECKS, state)) == full(spark, table(), parent), changed
    # a parent that changes has its relationships counted anew everywhere
    parent = spark.createDataFrame([(1,), (99,)], "id int")
    check_state.update_checks(table(), CHECKS, state, [day(5)], {"parent": parent})
    assert tuples(check_state.read_checks(spark, "t", CHECKS, state)) == full(spark, table(), parent)
    assert len(names(spark, f"{state}/repeated")) == len(names(spark, f"{state}/parents")) == 1


def test_only_the_days_that_changed_are_read(spark, folder):
    rows = [(i, 1.0, 1, dt.datetime.combine(day(i), dt.time(5))) for i in range(5)]
    path = f"{folder}/table"
    sinks.write_day_partitioned(spark.createDataFrame(rows, SCHEMA), path, "ts")
    parent = spark.createDataFrame([(1,)], "id int")
    table = sinks.read_days(spark, path, spark.createDataFrame([], SCHEMA).schema)
    check_state.update_checks(table, CHECKS, f"{folder}/state", [day(i) for i in range(5)], {"parent": parent})
    # files of other days may be gone: nobody looks for them
    for i in (0, 1, 3, 4):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ts_day={day(i)}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    check_state.update_checks(table, CHECKS, f"{folder}/state", [day(2)], {"parent": parent})
    assert {r.column: r.failing for r in check_state.read_checks(spark, "t", CHECKS[:1], f"{folder}/state").collect()} == {"k": 0}


def test_a_run_that_died_is_repeated(spark, folder, monkeypatch):
    path, state = f"{folder}/table", f"{folder}/state"
    parent = spark.createDataFrame([(1,)], "id int")
    at = lambda i: dt.datetime.combine(day(i), dt.time(5))
    sinks.write_day_partitioned(spark.createDataFrame([(7, 1.0, 1, at(0)), (7, 1.0, 1, at(1))], SCHEMA), path, "ts")
    schema = spark.createDataFrame([], SCHEMA).schema
    check_state.update_checks(sinks.read_days(spark, path, schema), CHECKS, state, [day(0), day(1)], {"parent": parent})
    sinks.replace_days(spark.createDataFrame([(8, 1.0, 1, at(1))], SCHEMA), path, "ts", [day(1)])

    def dies(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(check_state, "_update_repeated", dies)
        with pytest.raises(RuntimeError):
            check_state.update_checks(sinks.read_days(spark, path, schema), CHECKS, state, [day(1)], {"parent": parent})
    table = sinks.read_days(spark, path, schema)
    check_state.update_checks(table, CHECKS, state, [day(1)], {"parent": parent})
    assert tuples(check_state.read_checks(spark, "t", CHECKS, state)) == full(spark, table, parent)
    assert check_state.read_checks(spark, "t", CHECKS, state).filter((F.col("column") == "k") & (F.col("failing") > 0)).count() == 0
