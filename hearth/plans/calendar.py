"""Public holidays from a rule, in the shape of the holiday seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Holidays with the same date every year.
FIXED_DAYS = [
    ("01-01", "New Year's Day"),
    ("02-24", "Independence Day"),
    ("05-01", "Spring Day"),
    ("06-23", "Victory Day"),
    ("06-24", "Midsummer Day (St. John's Day)"),
    ("08-20", "Independence Restoration Day"),
    ("12-24", "Christmas Eve"),
    ("12-25", "Christmas Day"),
    ("12-26", "Second Day of Christmas"),
]

# Holidays counted in days from Easter Sunday.
EASTER_DAYS = [
    (-2, "Good Friday"),
    (0, "Easter Sunday"),
    (49, "Pentecost (Whit Sunday)"),
]

def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the Gauss method, as integer column arithmetic."""
    whole = lambda x: F.floor(x)
    century = whole(year / 100)
    moon_shift = (15 - whole((13 + 8 * century) / 25) + century - whole(century / 4)) % 30
    sun_shift = (4 + century - whole(century / 4)) % 7
    full_moon = (19 * (year % 19) + moon_shift) % 30
    to_sunday = (2 * (year % 4) + 4 * (year % 7) + 6 * full_moon + sun_shift) % 7
    days = (
        F.when((full_moon == 29) & (to_sunday == 6), F.lit(28))
        .when((full_moon == 28) & (to_sunday == 6) & (year % 19 > 10), F.lit(27))
        .otherwise(full_moon + to_sunday)
    )
    return F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(22)), days.cast("int"))


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """``(timestamp date, name)`` for a range of years, one row per holiday.

    For a published list use :func:`hearth.sources.read_seed`.
    """
    years = spark.range(first_year, last_year + 1).select(F.col("id").alias("year"))
    easter = easter_sunday(F.col("year"))
    fixed = [
        F.struct(
            F.to_date(F.concat_ws("-", F.col("year").cast("string"), F.lit(day))).alias("timestamp"),
            F.lit(name).alias("name"),
        )
        for day, name in FIXED_DAYS
    ]
    movable = [
        F.struct(F.date_add("easter", offset).alias("timestamp"), F.lit(name).alias("name"))
        for offset, name in EASTER_DAYS
    ]
    return years.withColumn("easter", easter).select(F.inline(F.array(*fixed, *movable)))
