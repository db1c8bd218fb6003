"""Composed models, quality checks and the backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hearth import sinks
from hearth.operators import check_state, quality
from hearth.plans import access, exploration, gold, ingest, silver
from hearth.plans.suites import DIAGRAM_CHECKS, GOVERNANCE_CHECKS, STAR_CHECKS
from hearth.schemas import RAW_COLUMNS
from hearth.session import scratch_path
from hearth.sources.registry import bronze_path

from . import feeds, landing, marts
from .entry import Entry
from .feeds import outer_merge_sql, with_feeds
from .scalars import MEASURE_NAMES

ENTRIES: dict[str, Entry] = {}


def register(name: str, sql: str | None, floats=()):
    def add(run):
        ENTRIES[name] = Entry(run, sql, floats)
        return run

    return add


# Columns that have values in the feeds; the others are NULL throughout.
SENSOR_AVERAGES = [
    "heat_pump_power_avg", "boiler_power_avg", "living_room_hum_perc_avg", "living_room_temp_avg", "boiler_voltage_avg",
]


# -- models ------------------------------------------------------------------


@register("g1_stg_iot", with_feeds("stg_iot", "SELECT * FROM stg_iot"), SENSOR_AVERAGES)
def _(spark, sf):
    return silver.stg_iot(feeds.readings(spark, sf))


@register(
    "g2_stg_weather",
    with_feeds("stg_weather", 'SELECT row_number() OVER (ORDER BY timestamp) AS "WeatherKey", * FROM stg_weather'),
    silver.WEATHER_COLUMNS,
)
def _(spark, sf):
    return silver.keyed_weather(silver.stg_weather(feeds.weather(spark, sf)))


@register("g3_stg_price", with_feeds("stg_price", "SELECT * FROM stg_price"), ["price_eur_per_kwh"])
def _(spark, sf):
    return silver.stg_price(feeds.prices(spark, sf), zone="EE", latest_only=True)


@register(
    "g4_stg_device",
    with_feeds(
        "devices",
        """SELECT row_number() OVER (ORDER BY "Brand" NULLS FIRST, "Model" NULLS FIRST, "InstallationDate" NULLS FIRST,
       "ValidTo" NULLS FIRST) AS "DeviceKey", * FROM devices""",
    ),
)
def _(spark, sf):
    return silver.stg_device(feeds.devices(spark, sf))


@register(
    "g4_stg_location",
    with_feeds(
        "locations",
        """SELECT row_number() OVER (ORDER BY "DeviceLocation", "ClosestWeatherStation", "PricingRegion",
       "ValidFrom" NULLS FIRST, "ValidTo" NULLS FIRST) AS "LocationKey", * FROM locations""",
    ),
)
def _(spark, sf):
    return silver.stg_location(feeds.locations(spark, sf))


@register("g5_dim_time", with_feeds("dim_time", "SELECT * FROM dim_time"))
def _(spark, sf):
    hours = gold.needed_hours(
        silver.stg_iot(feeds.readings(spark, sf)),
        silver.stg_weather(feeds.weather(spark, sf)),
        silver.stg_price(feeds.prices(spark, sf)),
    )
    return gold.dim_time(hours, feeds.holidays(spark))


@register("g6_dim_device", with_feeds("dim_device", "SELECT * FROM dim_device"))
def _(spark, sf):
    return gold.dim_device(feeds.devices(spark, sf))


@register("g7_dim_location", with_feeds("dim_location", "SELECT * FROM dim_location"))
def _(spark, sf):
    return gold.dim_location(feeds.locations(spark, sf))


@register("g8_fact_energy", with_feeds("fact", "SELECT * FROM fact"), MEASURE_NAMES)
def _(spark, sf):
    return marts.build(spark, sf).fact


@register("g9_full_access", with_feeds("fact", "SELECT * FROM fact"), MEASURE_NAMES)
def _(spark, sf):
    return access.full_access(marts.star(spark, sf).fact)


@register(
    "g10_limited_access",
    with_feeds("limited", "SELECT * FROM limited"),
    [name for name in MEASURE_NAMES if name not in ("ElectricityPrice", "ASHP_Power", "WC_Temp")],
)
def _(spark, sf):
    return access.limited_access(marts.star(spark, sf).fact)


@register("g11_wide_raw", with_feeds("readings", outer_merge_sql(RAW_COLUMNS)))
def _(spark, sf):
    return exploration.wide_raw(feeds.readings(spark, sf))


@register(
    "g12_backfill",
    with_feeds(
        "fact",
        """SELECT * REPLACE (CASE WHEN "OutdoorHumidityPerc" IS NOT NULL THEN 'unknown' END AS "WeatherCondition")
FROM fact""",
        once=True,
    ),
    MEASURE_NAMES,
)
def _(spark, sf):
    root = scratch_path(spark, "backfill-bronze")
    stale = feeds.readings(spark, sf).withColumn("state", F.lit("999"))
    sinks.write_day_partitioned(stale, bronze_path(root, "bronze_iot_raw_data"), "last_changed")
    sinks.write_day_partitioned(
        feeds.weather(spark, sf), bronze_path(root, "bronze_weather_history"), "last_changed"
    )
    sinks.overwrite(feeds.devices(spark, sf), bronze_path(root, "bronze_device"))
    sinks.overwrite(feeds.locations(spark, sf), bronze_path(root, "bronze_location"))
    # from the first reading to the hour after the last observation of any kind
    times = [feeds.readings(spark, sf).select("last_changed"), feeds.weather(spark, sf).select("last_changed"), feeds.prices(spark, sf).select("ts_utc")]
    bounds = [df.agg(F.min(df.columns[0]), F.max(df.columns[0])).first() for df in times]
    first = min(b[0] for b in bounds).replace(minute=0, second=0, microsecond=0)
    last = max(b[1] for b in bounds).replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    landed = ingest.Landing(
        statistics=landing.backfill_statistics(spark, sf),
        prices=landing.backfill_prices(spark, sf),
        weather=landing.backfill_weather(spark, sf),
    )
    star, _ = ingest.backfill(
        spark,
        root,
        landed,
        first,
        last,
        holidays=feeds.holidays(spark),
        marts=scratch_path(spark, "backfill-marts"),
    )
    return star.fact


# -- quality -----------------------------------------------------------------


def _check_sql(check: quality.Check) -> str:
    head = f"SELECT '{check.table}' AS \"table\", '{check.column}' AS \"column\", '{check.label.replace(chr(39), chr(39) * 2)}' AS \"check\","
    column = f'"{check.column}"'
    if check.kind == "not_null":
        return f"{head} count(*) AS failing FROM {check.table} WHERE {column} IS NULL"
    if check.kind == "unique":
        return f"""{head} count(*) AS failing FROM (SELECT {column} FROM {check.table} WHERE {column} IS NOT NULL
GROUP BY 1 HAVING count(*) > 1) AS d"""
    if check.kind == "relationships":
        return f"""{head} count(*) AS failing FROM {check.table} WHERE {column} IS NOT NULL
AND {column} NOT IN (SELECT "{check.parent_key}" FROM {check.parent})"""
    return f"{head} count(*) AS failing FROM {check.table} WHERE NOT ({check.expression})"


def _suite_sql(checks) -> str:
    return with_feeds(
        "dim_time dim_device dim_location fact", "\nUNION ALL\n".join(_check_sql(c) for c in checks)
    )


def _suite(checks):
    return lambda spark, sf: quality.run_suite(marts.star(spark, sf).tables(), checks)


@register("q1_not_null", with_feeds("weather", 'SELECT last_changed, condition_state FROM weather WHERE "temperature_C" IS NULL'))
def _(spark, sf):
    return quality.not_null(feeds.weather(spark, sf), "temperature_C").select("last_changed", "condition_state")


@register("q2_unique", "SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return quality.unique(feeds.table(spark, sf, "lineitem"), "l_orderkey")


@register(
    "q3_relationships",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def _(spark, sf):
    solvent = feeds.table(spark, sf, "customer").filter("c_acctbal > 0")
    placed = feeds.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.relationships(placed, "o_custkey", solvent, "c_custkey")


@register("q4_expression_rows", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)")
def _(spark, sf):
    named = feeds.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return quality.expression_is_true(named, ">= 0", "c_acctbal")


@register("q4_expression_marker", "SELECT 1 AS failing FROM customer WHERE NOT (c_acctbal >= 0)")
def _(spark, sf):
    return quality.expression_is_true(feeds.table(spark, sf, "customer"), "c_acctbal >= 0", "c_acctbal", full_rows=False)


@register("q5_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(spark, sf):
    placed = feeds.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return quality.accepted_values(placed, "o_orderstatus", ["F", "O"])


@register("q6_out_of_bounds", "SELECT event_id, value FROM events WHERE NOT (value BETWEEN 0 AND 100)")
def _(spark, sf):
    return quality.out_of_bounds(feeds.events(spark, sf), "value", 0, 100).select("event_id", "value")


@register("q7_order_violations", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_tax >= l_discount)")
def _(spark, sf):
    broken = quality.order_violations(feeds.table(spark, sf, "lineitem"), "l_discount", "l_tax")
    return broken.select("l_orderkey", "l_linenumber")


ENTRIES["q8_governance"] = Entry(_suite(GOVERNANCE_CHECKS), _suite_sql(GOVERNANCE_CHECKS))
ENTRIES["q9_diagram_checks"] = Entry(_suite(DIAGRAM_CHECKS), _suite_sql(DIAGRAM_CHECKS))
ENTRIES["q10_run_suite"] = Entry(_suite(STAR_CHECKS), _suite_sql(STAR_CHECKS))


EVENT_CHECKS = [
    quality.Check("events", "event_id", "unique"),
    quality.Check("events", "value", "not_null"),
    quality.Check("events", "value", "expression", "value BETWEEN 5 AND 90"),
    quality.Check("events", "user_id", "relationships", parent="customer", parent_key="c_custkey"),
]


@register(
    "q10_daily_state",
    """SELECT 'events' AS "table", 'event_id' AS "column", 'unique' AS "check",
  (SELECT count(*) FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1) d) AS failing
UNION ALL SELECT 'events', 'value', 'not_null', (SELECT count(*) FROM events WHERE value IS NULL)
UNION ALL SELECT 'events', 'value', 'value BETWEEN 5 AND 90', (SELECT count(*) FROM events WHERE NOT (value BETWEEN 5 AND 90))
UNION ALL SELECT 'events', 'user_id', 'relationships', (SELECT count(*) FROM events WHERE user_id IS NOT NULL
  AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))""",
)
def _(spark, sf):
    """Checks of all days while one is damaged, then of that day alone when it is right again."""
    path, state = scratch_path(spark, "checked-events"), scratch_path(spark, "check-state")
    events = feeds.events(spark, sf).select("event_id", "user_id", "value", "ts")
    day = events.agg(F.to_date(F.min("ts"))).first()[0]
    first = F.to_date("ts") == F.lit(day)
    damaged = events.withColumns({"value": F.when(~first, F.col("value")), "event_id": F.when(first, F.lit(1)).otherwise(F.col("event_id"))})
    parents = {"customer": feeds.table(spark, sf, "customer").filter("c_acctbal > 0")}
    sinks.write_day_partitioned(damaged, path, "ts")
    stored = sinks.read_days(spark, path, events.schema)
    check_state.update_checks(stored, EVENT_CHECKS, state, sinks.days_of(stored), parents)
    sinks.replace_days(events.filter(first), path, "ts", [day])
    check_state.update_checks(sinks.read_days(spark, path, events.schema), EVENT_CHECKS, state, [day], parents)
    return check_state.read_checks(spark, "events", EVENT_CHECKS, state)
