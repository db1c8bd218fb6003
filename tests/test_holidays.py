"""The holiday rule against known dates."""

import datetime as dt

from hearth.plans.calendar import holidays


def by_name(spark, name):
    rows = holidays(spark, 2020, 2040).filter(f"name = '{name}'").collect()
    return {r.timestamp.year: r.timestamp for r in rows}


def test_twelve_days_a_year_all_distinct(spark):
    rows = holidays(spark, 2020, 2040)
    assert rows.count() == 252
    assert rows.select("timestamp").distinct().count() == 252


def test_known_easter_sundays(spark):
    easter = by_name(spark, "Easter Sunday")
    known = {2020: (4, 12), 2024: (3, 31), 2025: (4, 20), 2035: (3, 25), 2038: (4, 25), 2040: (4, 1)}
    assert {y: (easter[y].month, easter[y].day) for y in known} == known


def test_special_gregorian_years(spark):
    easter = {
        r.timestamp.year: r.timestamp
        for r in holidays(spark, 1954, 2076).filter("name = 'Easter Sunday'").collect()
    }
    assert easter[1954] == dt.date(1954, 4, 18)
    assert easter[1981] == dt.date(1981, 4, 19)
    assert easter[2076] == dt.date(2076, 4, 19)


def test_days_counted_from_easter(spark):
    assert by_name(spark, "Good Friday")[2024] == dt.date(2024, 3, 29)
    assert by_name(spark, "Pentecost (Whit Sunday)")[2024] == dt.date(2024, 5, 19)
