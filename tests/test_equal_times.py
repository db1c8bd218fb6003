"""Different events of one type at one instant: the queries that drop repeats against their SQL."""

import os

import pytest
from oracle import TABLES, connect, difference

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def collided(tmp_path_factory):
    """The tables, but 40 events have a twin of another value and 20 are there twice."""
    folder = str(tmp_path_factory.mktemp("collided"))
    con = connect(SF)
    con.execute(
        f"""COPY (SELECT * FROM events
        UNION ALL SELECT event_id + 100000, ts, user_id, event_type, value + 1, props FROM events WHERE event_id % 25 = 3
        UNION ALL SELECT event_id + 200000, ts, user_id, event_type, value, props FROM events WHERE event_id % 50 = 7)
        TO '{folder}/events.parquet' (FORMAT parquet)"""
    )
    for name in TABLES:
        if name != "events":
            os.symlink(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    return folder


def check(spark, folder, name):
    assert difference(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name]) is None


def test_k3_replace_range(spark, collided):
    check(spark, collided, "k3_replace_range")


def test_x3_dedup(spark, collided):
    check(spark, collided, "x3_dedup")


def test_x3_late_rows(spark, collided):
    check(spark, collided, "x3_late_rows")


def test_x4_upsert_interval(spark, collided):
    check(spark, collided, "x4_upsert_interval")
