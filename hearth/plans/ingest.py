"""Loads of landed payloads: the hourly interval, a backfill, a late replay.

Every load stages and checks its batch before anything is deleted, so an empty
landing folder, or one broken document in it, leaves the stored rows alone. Landed
documents are read and parsed once, by the write that stages them; it also counts
their rows, and each load says what it did with them. When to run a load is up to the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import backfill_cutoff, hour_start
from ..operators.aggregates import coverage
from ..operators.filters import as_time, in_list, in_window, time_window
from ..operators.quality import run_suite
from ..schemas import BRONZE_IOT, BRONZE_PRICE, BRONZE_WEATHER, SENSOR_COLUMNS
from ..sinks import (
    days_of,
    on_days,
    read_days,
    replace_days,
    replace_interval,
    replace_range_backfill,
    staged_batch,
    upsert_rows,
    with_day,
    write_day_partitioned,
)
from ..sources import (
    read_bronze,
    read_hourly_weather,
    read_iot_history,
    read_price,
    read_statistics,
    read_weather_history,
)
from ..sources.registry import bronze_path
from ..streaming.late import late_rows, mark_replayed, pending_batches
from ..together import together
from .silver import stg_iot, stg_price, stg_weather
from .star import Star, assemble_star
from .suites import STAR_CHECKS

IOT, WEATHER, PRICE = "bronze_iot_raw_data", "bronze_weather_history", "bronze_price"


# Hourly staging of each log: name, model, its hour, and the schema of the log.
STAGING = {
    IOT: ("stg_iot", stg_iot, "hour_start", BRONZE_IOT),
    WEATHER: ("stg_weather", stg_weather, "timestamp", BRONZE_WEATHER),
    PRICE: ("stg_price", stg_price, "timestamp", BRONZE_PRICE),
}

# What names a row of each log.
KEYS = {
    IOT: ("last_changed", ["entity_id", "last_changed"]),
    WEATHER: ("last_changed", ["entity_id", "last_changed"]),
    PRICE: ("ts_utc", ["zone", "ts_utc"]),
}


@dataclass(frozen=True)
class Loaded:
    """What a load did with one log: whether the log changed, how many landed rows lie
    in the interval, elsewhere, or have no time, how many hours from the cutoff on
    were skipped, and which known sensors had no row. ``days`` are those to stage anew."""

    changed: bool
    inside: int
    elsewhere: int
    untimed: int
    skipped: int = 0
    missing: tuple[str, ...] = ()
    days: tuple = field(default=(), compare=False, repr=False)


@dataclass(frozen=True)
class Landing:
    """Folders of landed JSON payloads.

    An hourly load reads whole folders, so give it those of its own interval.

    ``history`` holds state histories, ``statistics`` long-term statistics; a
    backfill turns to the histories when the statistics have no rows.
    ``weather`` holds weather histories for an hourly load and hourly arrays
    for a backfill.
    """

    prices: str
    weather: str
    statistics: str | None = None
    history: str | None = None
    per: str = "line"


def _known_sensors(readings: DataFrame) -> DataFrame:
    return in_list(readings, "entity_id", list(SENSOR_COLUMNS))


def cutoff(now) -> Column:
    """End of a backfill that must not meet the running hourly load."""
    return backfill_cutoff(as_time(now))


def _places(ts: str, start, end) -> dict[str, Column]:
    """Counts of rows in the interval, elsewhere, and without a time, for the write that stages a batch."""
    inside = F.coalesce(in_window(ts, start, end), F.lit(False))
    timed = F.col(ts).isNotNull()
    return {"inside": F.count_if(inside), "elsewhere": F.count_if(timed & ~inside), "untimed": F.count_if(~timed)}


def _touched_days(df: DataFrame, ts: str, start, end) -> tuple:
    """Days of the batch and of the interval; bounded by the calendar."""
    last = as_time(end) - F.expr("interval 1 microsecond")
    days = F.sequence(F.to_date(as_time(start)), F.greatest(F.to_date(last), F.to_date(as_time(start))))
    interval = df.sparkSession.range(1).select(days.alias("days")).first()["days"]
    return tuple(sorted({*interval, *days_of(with_day(df.filter(F.col(ts).isNotNull()), ts))}))


def _load(df: DataFrame, root: str, name: str, start, end) -> Loaded:
    """Replace the interval by the rows inside; rows elsewhere replace those of their own keys.

    The landed documents are parsed by the one write that stages the batch, which also
    counts its rows; all that follows reads staged rows.
    """
    ts, keys = KEYS[name]
    path = bronze_path(root, name)
    with staged_batch(df, path, **_places(ts, start, end)) as (rows, tally):
        changed = replace_interval(time_window(rows, ts, start, end), path, ts, start, end, is_staged=True)
        if tally["elsewhere"]:
            upsert_rows(rows.filter(F.col(ts).isNotNull() & ~in_window(ts, start, end)), path, ts, keys)
        return Loaded(changed or tally["elsewhere"] > 0, **tally, days=_touched_days(rows, ts, start, end))


def load_interval(spark: SparkSession, root: str, landing: Landing, start, end) -> dict[str, Loaded]:
    """Replace ``[start, end)`` of the three bronze logs with what has landed.

    Landed rows outside the interval are kept: they are inserted, or replace the
    stored row of their key, so a rerun changes nothing. Rows without a time fit
    nowhere; they are counted.
    """
    loads = {
        IOT: _known_sensors(read_iot_history(spark, landing.history, per=landing.per)),
        WEATHER: read_weather_history(spark, landing.weather, per=landing.per),
        PRICE: read_price(spark, landing.prices, per=landing.per),
    }
    found = together(spark, *[partial(_load, df, root, name, start, end) for name, df in loads.items()])
    return dict(zip(loads, found, strict=True))


def _fill(rows: DataFrame, root: str, name: str, start, end, tally: dict[str, int]) -> Loaded:
    """Replace the range by the newest of the staged rows inside; others are only counted."""
    ts, keys = KEYS[name]
    inside = time_window(rows, ts, start, end)
    changed = replace_range_backfill(inside, bronze_path(root, name), ts, start, end, keys)
    return Loaded(changed, **tally, days=_touched_days(inside, ts, start, end))


def _fill_readings(spark: SparkSession, root: str, landing: Landing, start, end) -> Loaded:
    """From statistics, or from histories where those have no row in the range."""
    ts, path = KEYS[IOT][0], bronze_path(root, IOT)
    sources = []
    if landing.statistics is not None:
        sources.append(read_statistics(spark, landing.statistics, per=landing.per))
    if landing.history is not None or not sources:
        sources.append(read_iot_history(spark, landing.history, per=landing.per))
    for place, readings in enumerate(sources, 1):
        with staged_batch(_known_sensors(readings), path, **_places(ts, start, end)) as (rows, tally):
            if tally["inside"] or place == len(sources):
                found = _fill(rows, root, IOT, start, end, {"inside": tally["inside"], "elsewhere": 0, "untimed": 0})
                return replace(found, missing=_missing(time_window(rows, ts, start, end)))
    raise AssertionError("the last source is always taken")


def _fill_prices(spark: SparkSession, root: str, landing: Landing, start, end) -> Loaded:
    prices = read_price(spark, landing.prices, per=landing.per)
    with staged_batch(prices, bronze_path(root, PRICE), **_places(KEYS[PRICE][0], start, end)) as (rows, tally):
        return _fill(rows, root, PRICE, start, end, tally)


def _fill_weather(spark: SparkSession, root: str, landing: Landing, start, end) -> Loaded:
    """Hours from ``end`` on are skipped, and counted as such."""
    ts = KEYS[WEATHER][0]
    hours = read_hourly_weather(spark, landing.weather, F.lit("9999-12-31").cast("timestamp"), per=landing.per)
    measures = _places(ts, start, end) | {"skipped": F.count_if(F.col(ts) >= as_time(end))}
    with staged_batch(hours, bronze_path(root, WEATHER), **measures) as (rows, tally):
        skipped = tally.pop("skipped")
        found = _fill(rows, root, WEATHER, start, end, tally | {"elsewhere": tally["elsewhere"] - skipped})
        return replace(found, skipped=skipped)


def _missing(readings: DataFrame) -> tuple[str, ...]:
    """Known sensors without a row; at most as many as there are sensors."""
    rows = coverage(readings, "entity_id", list(SENSOR_COLUMNS)).filter("NOT present").collect()
    return tuple(sorted(row["entity_id"] for row in rows))


def load_range(spark: SparkSession, root: str, landing: Landing, start, end) -> dict[str, Loaded]:
    """Replace a long range of the three bronze logs; the newest version of a key counts.

    Rows outside the range are left to other loads; they are counted, as are the
    weather hours from ``end`` on and the sensors that have no rows.
    """
    fills = {IOT: _fill_readings, PRICE: _fill_prices, WEATHER: _fill_weather}
    found = together(spark, *[partial(fill, spark, root, landing, start, end) for fill in fills.values()])
    return dict(zip(fills, found, strict=True))


def _staging_path(marts: str, name: str) -> str:
    return f"{marts.rstrip('/')}/staging/{STAGING[name][0]}"


def _restage(spark: SparkSession, root: str, marts: str, name: str, days: tuple | None) -> DataFrame:
    """Hourly staging of one log, made anew for ``days`` or, with None, as a whole.

    An hour lies within one day of its log, so a day's hours need that day only.
    """
    _, model, hour, schema = STAGING[name]
    path, log = _staging_path(marts, name), read_days(spark, bronze_path(root, name), schema)
    hourly = model((log if days is None else log.filter(on_days(days))).drop("ts_day"))
    if days is None:
        write_day_partitioned(hourly, path, hour, mode="overwrite")
    elif days:
        replace_days(hourly, path, hour, days)
    # a log without rows leaves a table without files
    return read_days(spark, path, hourly.schema).drop("ts_day")


def _is_staged(spark: SparkSession, marts: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_staging_path(marts, name)}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def rebuild(
    spark: SparkSession,
    root: str,
    *,
    holidays: DataFrame,
    marts: str,
    loaded: dict[str, Loaded] | None = None,
    stable_keys: bool = False,
) -> tuple[Star, DataFrame]:
    """Build every model from the bronze tables below ``root`` and test the star.

    Staging lies in day partitions below ``marts``. After a load only its days are
    staged anew (``loaded`` tells them; without it, or the first time, all are);
    dimensions and fact, which have a row per hour, are built as a whole.

    With ``stable_keys`` a registry below ``marts`` keeps every surrogate key, also when
    hours arrive late, and only facts of the load's days are computed. Say it from the
    first build on; keys given before it began are not in the registry.
    """

    def days(name: str) -> tuple | None:
        return loaded[name].days if loaded is not None and _is_staged(spark, marts, name) else None

    parts = [days(name) for name in STAGING]
    staged = together(spark, *[partial(_restage, spark, root, marts, name, part) for name, part in zip(STAGING, parts, strict=True)])
    known = stable_keys and all(part is not None for part in parts)
    star = assemble_star(
        stg_iot=staged[0],
        stg_weather=staged[1],
        stg_price=staged[2],
        bronze_device=read_bronze(spark, root, "bronze_device"),
        bronze_location=read_bronze(spark, root, "bronze_location"),
        holidays=holidays,
        root=marts,
        registry=f"{marts.rstrip('/')}/keys" if stable_keys else None,
        touched=sorted({day for part in parts for day in part}) if known else None,
    )
    return star, run_suite(star.tables(), STAR_CHECKS)


def _ignore(loaded: dict[str, Loaded]) -> None:
    pass


def run(
    spark: SparkSession,
    root: str,
    landing: Landing,
    start,
    end,
    *,
    holidays: DataFrame,
    marts: str,
    on_load: Callable[[dict[str, Loaded]], None] = _ignore,
    stable_keys: bool = False,
) -> tuple[Star, DataFrame]:
    """One scheduled interval: load, rebuild, test. ``on_load`` is told what was loaded."""
    loaded = load_interval(spark, root, landing, start, end)
    on_load(loaded)
    return rebuild(spark, root, holidays=holidays, marts=marts, loaded=loaded, stable_keys=stable_keys)


def backfill(
    spark: SparkSession,
    root: str,
    landing: Landing,
    start,
    end,
    *,
    holidays: DataFrame,
    marts: str,
    on_load: Callable[[dict[str, Loaded]], None] = _ignore,
    stable_keys: bool = False,
) -> tuple[Star, DataFrame]:
    """A closed range: load, rebuild, test. ``on_load`` is told what was loaded."""
    loaded = load_range(spark, root, landing, start, end)
    on_load(loaded)
    return rebuild(spark, root, holidays=holidays, marts=marts, loaded=loaded, stable_keys=stable_keys)


def late_replay(batch: DataFrame, bronze: str, hourly: str, start, end) -> DataFrame:
    """Replace a closed range of readings and recompute only its hours.

    Averages cannot be merged from finished averages, so every hour that the range
    touches is recomputed as a whole from bronze. Returns the stored hourly table.
    """
    spark = batch.sparkSession
    replace_interval(batch, bronze, "last_changed", start, end)
    first = F.date_trunc("hour", as_time(start))
    whole = F.date_trunc("hour", as_time(end))
    last = F.when(whole == as_time(end), whole).otherwise(whole + F.expr("interval 1 hour"))
    stored = read_days(spark, bronze, BRONZE_IOT)
    touched = time_window(stored, "last_changed", first, last, day="ts_day")
    recomputed = stg_iot(touched)
    replace_interval(recomputed, hourly, "hour_start", first, last, allow_empty=True)
    return spark.read.parquet(hourly).select(*recomputed.columns)


def replay_late(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    ts: str,
    keys: Sequence[str],
    bronze: str,
    *,
    hourly: str | None = None,
    model: Callable[[DataFrame], DataFrame] = stg_iot,
    hour: str = "hour_start",
) -> int:
    """Bring in the late rows below ``root`` (see :mod:`hearth.streaming.late`); returns their number.

    They replace the rows of their ``keys`` in ``bronze``, and the hours they name are
    computed anew from it by ``model`` and replace those of ``hourly``. Only days with late
    rows are read or written. A replay that dies is made again by the next one.
    """
    batches = pending_batches(spark, root)
    if not batches:
        return 0
    seen = Observation()
    late = late_rows(spark, root, schema, ts, batches).observe(seen, F.count(F.lit(1)).alias("rows"))
    upsert_rows(late.drop("late_hour"), bronze, ts, keys)
    if hourly is not None:
        # at most one row per hour of the calendar
        hours = late_rows(spark, root, schema, ts, batches).select(F.col("late_hour").alias("_hour")).distinct()
        days = days_of(hours.select(F.to_date("_hour").alias("ts_day")))
        stored = read_days(spark, bronze, schema).filter(on_days(days))
        touched = stored.join(hours, hour_start(stored[ts]) == hours["_hour"], "left_semi")
        upsert_rows(model(touched.select(*schema.names)), hourly, hour, [hour])
    mark_replayed(spark, root, batches)
    return seen.get["rows"]
