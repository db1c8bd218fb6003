"""Every registered query against its SQL oracle, on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle import connect, difference
from workbench.registry import all_entries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(all_entries()) <= set(entry.queries()) & set(entry.oracle_sql())


def test_inventory_is_covered():
    counts = {
        "s": 11, "k": 10, "p": 13, "f": 13, "j": 11, "a": 20, "w": 4, "o": 6, "u": 3, "dt": 15,
        "m": 8, "t": 4, "c": 5, "n": 5, "g": 12, "y": 13, "q": 10, "x": 7,
    }
    prefixes = {name.split("_")[0].rstrip("ab") for name in entry.queries()}
    missing = [f"{k}{i}" for k, n in counts.items() for i in range(1, n + 1) if f"{k}{i}" not in prefixes]
    assert not missing


@pytest.mark.parametrize("name", sorted(all_entries()))
def test_matches_oracle(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
