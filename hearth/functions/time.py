"""Date and time expressions.

Hour buckets are UTC instants. Local calendar fields are derived from the
instant, so the two 03:00 hours of an autumn clock change stay apart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import LOCAL_ZONE
from .parse import safe_number

# Calendar classes.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
DEFAULT_SEASON = "Autumn"
WEEKEND_DAYS = (6, 7)
PEAK_HOURS = (7, 8, 9, 17, 18, 19)
WIDE_PEAK_RANGE = (7, 22)
OPEN_START = dt.date(2000, 1, 1)
OPEN_END = dt.date(9999, 12, 31)
MILLIS_THRESHOLD = 1e12
EPOCH_RANGE = (-62135596800.0, 253402300799.0)  # years 1 to 9999

ISO_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def as_instant(col: Column) -> Column:
    """Zone-less UTC text or timestamp to an instant (session zone is UTC)."""
    return col.cast("timestamp")


def local_wall(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock label of an instant."""
    return F.from_utc_timestamp(ts, zone)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_wall(ts, zone))


def calendar_parts(wall: Column) -> dict[str, Column]:
    return {
        "Year": F.year(wall),
        "Month": F.month(wall),
        "Day": F.dayofmonth(wall),
        "HourOfDay": F.hour(wall),
    }


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + F.lit(1)


def season(month: Column) -> Column:
    branches = iter(SEASON_MONTHS.items())
    name, months = next(branches)
    chain = F.when(month.isin(*months), F.lit(name))
    for name, months in branches:
        chain = chain.when(month.isin(*months), F.lit(name))
    return chain.otherwise(F.lit(DEFAULT_SEASON))


def is_weekend(weekday: Column) -> Column:
    return weekday.isin(*WEEKEND_DAYS)


def is_peak(hour: Column, hours=PEAK_HOURS) -> Column:
    return hour.isin(*hours)


def is_peak_range(hour: Column, first: int = WIDE_PEAK_RANGE[0], last: int = WIDE_PEAK_RANGE[1]) -> Column:
    return hour.between(first, last)


def hour_of_local_day(day: Column, hours: Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant that lies ``hours`` elapsed hours after local midnight."""
    midnight = F.to_utc_timestamp(day.cast("timestamp"), zone)
    return F.timestamp_seconds(F.unix_timestamp(midnight) + hours * F.lit(3600))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; NULL when it is not one."""
    return F.when(text.rlike(ISO_PREFIX), F.try_to_timestamp(text))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def from_epoch_or_iso(text: Column) -> Column:
    """Epoch seconds, epoch milliseconds (told apart by size) or ISO text."""
    number = safe_number(text)
    seconds = F.when(number > F.lit(MILLIS_THRESHOLD), number / F.lit(1000.0)).otherwise(number)
    return F.coalesce(F.timestamp_seconds(F.when(seconds.between(*EPOCH_RANGE), seconds)), parse_iso(text))


def backfill_cutoff(now: Column) -> Column:
    """Start of the hour before the one ``now`` falls in."""
    return F.timestamp_seconds(F.unix_timestamp(hour_start(now)) - F.lit(3600))


def chunk_ranges(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Split each row's ``[start, end)`` into consecutive pieces of ``days``."""
    step = days * 86400
    first, last = F.unix_timestamp(F.col(start)), F.unix_timestamp(F.col(end))
    # the final partial piece needs a start too, so the sequence ends just before `end`
    begins = F.when(first < last, F.sequence(first, last - F.lit(1), F.lit(step)))
    return df.withColumn("_begin", F.explode(begins)).select(
        *df.columns,
        F.timestamp_seconds(F.col("_begin")).alias("chunk_start"),
        F.timestamp_seconds(F.least(F.col("_begin") + F.lit(step), last)).alias("chunk_end"),
    )


def valid_from_or_default(col: Column) -> Column:
    return F.coalesce(col, F.lit(OPEN_START))


def valid_to_or_default(col: Column) -> Column:
    return F.coalesce(col, F.lit(OPEN_END))
