"""Filters, joins, aggregations, keys, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.time import as_instant, hour_start, local_date, parse_iso
from hearth.functions.bins import floor_bin
from hearth.operators import aggregates, filters, joins, keys, ordering, sets
from hearth.operators.key_registry import stable_key
from hearth.plans import exploration, gold, silver
from hearth.schemas import SENSOR_COLUMNS
from hearth.session import scratch_path
from hearth.sizing import values_column

from . import feeds, marts
from .entry import GRID, Entry
from .feeds import wall, with_feeds

ENTRIES: dict[str, Entry] = {}

# Sums over money columns are large; compare them on a coarser grid.
MONEY = 2**20


def register(name: str, sql: str | None, floats=(), grid: int = GRID):
    def add(run):
        ENTRIES[name] = Entry(run, sql, floats, grid)
        return run

    return add


def lineitem(spark, sf):
    return feeds.table(spark, sf, "lineitem")


def orders(spark, sf):
    return feeds.table(spark, sf, "orders")


def customer(spark, sf):
    return feeds.table(spark, sf, "customer")


# -- filters -----------------------------------------------------------------


@register(
    "f1_not_null",
    with_feeds(
        "weather",
        'SELECT last_changed, condition_state, "temperature_C" FROM weather '
        'WHERE "temperature_C" IS NOT NULL AND condition_state IS NOT NULL',
    ),
)
def _(spark, sf):
    kept = filters.not_null(feeds.weather(spark, sf), "temperature_C", "condition_state")
    return kept.select("last_changed", "condition_state", "temperature_C")


@register(
    "f2_half_open_range",
    with_feeds("weather", 'SELECT last_changed, "temperature_C" FROM weather WHERE "temperature_C" >= -25 AND "temperature_C" < 30'),
)
def _(spark, sf):
    kept = filters.half_open(feeds.weather(spark, sf), "temperature_C", -25.0, 30.0)
    return kept.select("last_changed", "temperature_C")


@register("f3_between", "SELECT event_id, value FROM events WHERE value BETWEEN 19.5 AND 20.5")
def _(spark, sf):
    return filters.inclusive(feeds.events(spark, sf), "value", 19.5, 20.5).select("event_id", "value")


@register("f4_column_compare", "SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem WHERE l_tax > l_discount")
def _(spark, sf):
    kept = filters.greater_than_column(lineitem(spark, sf), "l_tax", "l_discount")
    return kept.select("l_orderkey", "l_linenumber", "l_tax", "l_discount")


@register(
    "f5_dimension_attribute",
    """SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING'""",
)
def _(spark, sf):
    segment = filters.equals(customer(spark, sf), "c_mktsegment", "BUILDING").select("c_custkey")
    placed = orders(spark, sf).withColumnRenamed("o_custkey", "c_custkey")
    return joins.key_join(placed, segment, "c_custkey").select("o_orderkey", "o_totalprice")


@register("f6_in_list", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 3, 5)")
def _(spark, sf):
    return filters.in_list(lineitem(spark, sf), "l_linenumber", [1, 3, 5]).select("l_orderkey", "l_linenumber")


@register(
    "f7_sensor_members",
    with_feeds("readings", "SELECT entity_id, last_changed FROM readings WHERE entity_id LIKE '%power' OR entity_id LIKE '%temperature'"),
)
def _(spark, sf):
    wanted = [s for s in SENSOR_COLUMNS if s.endswith("power") or s.endswith("temperature")]
    members = values_column(spark, "entity_id", wanted)
    kept = joins.semi_members(feeds.readings(spark, sf), "entity_id", members)
    return kept.select("entity_id", "last_changed")


@register(
    "f8_time_window",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'",
)
def _(spark, sf):
    return filters.time_window(feeds.events(spark, sf), "ts", "2024-01-05 06:00:00", "2024-01-12 18:00:00").select(
        "event_id", "ts"
    )


@register("f9_before_cutoff", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'")
def _(spark, sf):
    return filters.before_cutoff(feeds.events(spark, sf), "ts", "2024-01-20").select("event_id", "ts")


@register(
    "f9_cutoff_report",
    """SELECT count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20 00:00:00') AS kept,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-20 00:00:00') AS skipped FROM events""",
)
def _(spark, sf):
    return filters.cutoff_report(feeds.events(spark, sf), "ts", "2024-01-20")


_DAY_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"


def _stamped(spark, sf):
    return feeds.events(spark, sf).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"))


@register("f10_keep_prefix", f"SELECT event_id, {_DAY_TEXT} AS stamp FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07'")
def _(spark, sf):
    return filters.keep_prefix(_stamped(spark, sf), "stamp", "2024-01-07")


@register("f10_drop_prefix", f"SELECT event_id, {_DAY_TEXT} AS stamp FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-07'")
def _(spark, sf):
    return filters.drop_prefix(_stamped(spark, sf), "stamp", "2024-01-07")


@register("f11_free_or_negative", with_feeds("prices", "SELECT ts_utc, price_per_mwh FROM prices WHERE price_per_mwh <= 0"))
def _(spark, sf):
    return filters.free_or_negative_price(feeds.prices(spark, sf), "price_per_mwh").select("ts_utc", "price_per_mwh")


@register("f12_no_rows", "SELECT event_id, event_type FROM events WHERE 1 = 0 UNION ALL SELECT event_id, event_type FROM events")
def _(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "event_type")
    return filters.no_rows(e).unionByName(e)


@register("f13_with_time", "SELECT event_id, ts AS parsed FROM events WHERE event_id % 13 <> 0")
def _(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    garbled = F.when(F.col("event_id") % 13 == 0, F.lit("unknown")).otherwise(iso)
    parsed = feeds.events(spark, sf).select("event_id", parse_iso(garbled).alias("parsed"))
    return filters.with_time(parsed, "parsed")


# -- joins -------------------------------------------------------------------


@register(
    "j1_key_join",
    "SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _(spark, sf):
    placed = orders(spark, sf).select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return joins.key_join(placed, customer(spark, sf).select("c_custkey", "c_mktsegment"), "c_custkey")


@register(
    "j2_star_join_two",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderdate, c_mktsegment
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    dims = {
        "l_orderkey": orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"),
        "o_custkey": customer(spark, sf).select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
    }
    lines = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.star_join(lines, dims)


@register(
    "j3_star_join_three",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderdate, p_brand, s_nationkey FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def _(spark, sf):
    dims = {
        "l_orderkey": orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"),
        "l_partkey": feeds.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"),
        "l_suppkey": feeds.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
    }
    return joins.star_join(lineitem(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), dims)


@register(
    "j4_instant_join",
    with_feeds("stg_iot dim_time", 'SELECT hour_start, "TimeKey", "FullDate", "HourOfDay" FROM stg_iot JOIN dim_time ON hour_start = "HourTs"'),
)
def _(spark, sf):
    star = marts.star(spark, sf)
    calendar = star.dim_time.select("HourTs", "TimeKey", "FullDate", "HourOfDay")
    return joins.instant_join(star.stg_iot.select("hour_start"), calendar)


@register(
    "j5_hour_left_join",
    with_feeds(
        "stg_iot stg_weather stg_price",
        """SELECT hour_start, temperature_c, condition_state, price_eur_per_kwh FROM stg_iot
LEFT JOIN stg_weather w ON hour_start = w.timestamp LEFT JOIN stg_price p ON hour_start = p.timestamp""",
    ),
    ["temperature_c", "price_eur_per_kwh"],
)
def _(spark, sf):
    hours = silver.stg_iot(feeds.readings(spark, sf)).select("hour_start")
    observed = silver.stg_weather(feeds.weather(spark, sf)).withColumnRenamed("timestamp", "hour_start")
    priced = silver.stg_price(feeds.prices(spark, sf)).withColumnRenamed("timestamp", "hour_start")
    joined = joins.hour_join(joins.hour_join(hours, observed, "hour_start"), priced, "hour_start")
    return joined.select("hour_start", "temperature_c", "condition_state", "price_eur_per_kwh")


@register(
    "j6_flag_join",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity >= 50) AS is_busy
FROM orders""",
)
def _(spark, sf):
    busy = lineitem(spark, sf).filter("l_quantity >= 50").select(F.to_date("l_shipdate"))
    placed = orders(spark, sf).select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return joins.flag_join(placed, busy, "day", "is_busy")


@register(
    "j7_validity_join",
    with_feeds(
        "dim_device dim_location",
        f"""SELECT event_id, "DeviceKey", "LocationKey" FROM (SELECT event_id, CAST({wall('ts')} AS DATE) AS day FROM events) e
CROSS JOIN dim_device d CROSS JOIN dim_location l
WHERE day BETWEEN d."InstallationDate" AND d."ValidTo" AND day BETWEEN l."ValidFrom" AND l."ValidTo" """,
    ),
)
def _(spark, sf):
    star = marts.star(spark, sf)
    dated = feeds.events(spark, sf).select("event_id", local_date(F.col("ts")).alias("day"))
    with_device = joins.validity_join(
        dated, star.dim_device, "day", "InstallationDate", "ValidTo", carry=["DeviceKey"]
    )
    with_both = joins.validity_join(
        with_device, star.dim_location, "day", "ValidFrom", "ValidTo", carry=["LocationKey"]
    )
    return with_both.select("event_id", "DeviceKey", "LocationKey")


@register(
    "j8_validity_join_bucketed",
    with_feeds(
        "versions",
        """SELECT l_orderkey, l_linenumber, l_partkey, valid_from, level FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN versions ON custkey = o_custkey AND CAST(l_shipdate AS DATE) BETWEEN valid_from AND valid_to""",
    ),
)
def _(spark, sf):
    owners = orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("shipped")
    )
    return joins.validity_join_bucketed(
        joins.key_join(lines, owners, "l_orderkey"),
        feeds.customer_versions(spark, sf),
        "shipped",
        "valid_from",
        "valid_to",
        carry=["valid_from", "level"],
        keys=[("o_custkey", "custkey")],
    ).select("l_orderkey", "l_linenumber", "l_partkey", "valid_from", "level")


@register(
    "j9_overlapping_versions",
    with_feeds(
        "dim_device dim_location",
        f"""SELECT "DeviceKey", "LocationKey", count(*) AS days
FROM (SELECT DISTINCT CAST({wall('ts')} AS DATE) AS day FROM events) e CROSS JOIN dim_device d CROSS JOIN dim_location l
WHERE day BETWEEN d."InstallationDate" AND d."ValidTo" AND day BETWEEN l."ValidFrom" AND l."ValidTo" GROUP BY 1, 2""",
    ),
)
def _(spark, sf):
    star = marts.star(spark, sf)
    days = feeds.events(spark, sf).select(local_date(F.col("ts")).alias("day"))
    return joins.overlapping_versions(
        star.dim_device.select("DeviceKey", "InstallationDate", "ValidTo"),
        star.dim_location.select("LocationKey", "ValidFrom", "ValidTo"),
        days,
    )


@register(
    "j10_outer_merge",
    with_feeds(
        "readings",
        """SELECT coalesce(a.last_changed, b.last_changed, c.last_changed) AS timestamp, a.state AS heat_pump_power,
       b.state AS living_room_temp, c.state AS boiler_power
FROM (SELECT * FROM readings WHERE entity_id = 'sensor.ohksoojus_power') a
FULL JOIN (SELECT * FROM readings WHERE entity_id = 'sensor.tempniiskuslauaall_temperature') b
  ON a.last_changed = b.last_changed
FULL JOIN (SELECT * FROM readings WHERE entity_id = 'sensor.0xa4c138cdc6eff777_power') c
  ON coalesce(a.last_changed, b.last_changed) = c.last_changed""",
    ),
)
def _(spark, sf):
    columns = {
        "sensor.ohksoojus_power": "heat_pump_power",
        "sensor.tempniiskuslauaall_temperature": "living_room_temp",
        "sensor.0xa4c138cdc6eff777_power": "boiler_power",
    }
    return exploration.merge_sensors(feeds.readings(spark, sf), columns)


@register(
    "j11_orphans",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
)
def _(spark, sf):
    large = feeds.table(spark, sf, "part").filter("p_size > 10")
    lines = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.orphans(lines, "l_partkey", large, "p_partkey")


# -- aggregations ------------------------------------------------------------


@register(
    "a1_hourly_avg",
    with_feeds(
        "weather",
        """SELECT date_trunc('hour', last_changed) AS hour, avg("temperature_C") AS "temperature_C",
       avg(humidity_percent) AS humidity_percent FROM weather GROUP BY 1""",
    ),
    ["temperature_C", "humidity_percent"],
)
def _(spark, sf):
    return aggregates.hourly_avg(feeds.weather(spark, sf), "last_changed", ["temperature_C", "humidity_percent"])


@register(
    "a2_hourly_price",
    with_feeds("prices", "SELECT date_trunc('hour', ts_utc) AS hour, avg(price_per_mwh) AS price_per_mwh FROM prices GROUP BY 1"),
    ["price_per_mwh"],
)
def _(spark, sf):
    return aggregates.hourly_avg(feeds.prices(spark, sf), "ts_utc", ["price_per_mwh"])


@register(
    "a3_long_to_wide",
    """SELECT date_trunc('hour', ts) AS hour_start, avg(value) FILTER (WHERE event_type = 'click') AS clicks,
       avg(value) FILTER (WHERE event_type = 'view') AS views, avg(value) FILTER (WHERE event_type = 'error') AS errors,
       avg(value) FILTER (WHERE event_type = 'absent') AS absent FROM events GROUP BY 1""",
    ["clicks", "views", "errors"],
)
def _(spark, sf):
    columns = {"click": "clicks", "view": "views", "error": "errors", "absent": "absent"}
    return aggregates.hourly_wide(feeds.events(spark, sf), "ts", "event_type", "value", columns)


@register(
    "a4_avg_if",
    """SELECT l_returnflag, avg(l_quantity) FILTER (WHERE l_discount > 0.05) AS discounted_quantity
FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    discounted = aggregates.avg_if(F.col("l_quantity"), F.col("l_discount") > 0.05)
    return lineitem(spark, sf).groupBy("l_returnflag").agg(discounted.alias("discounted_quantity"))


@register(
    "a5_latest_in_group",
    with_feeds(
        "weather",
        "SELECT date_trunc('hour', last_changed) AS hour, arg_max(condition_state, last_changed) AS condition_state FROM weather GROUP BY 1",
    ),
)
def _(spark, sf):
    hour = {"hour": hour_start(F.col("last_changed"))}
    return aggregates.latest_in_group(feeds.weather(spark, sf), hour, "condition_state", "last_changed")


@register("a6_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return orders(spark, sf).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@register("a7_avg", "SELECT o_orderpriority, avg(o_totalprice) AS mean_price FROM orders GROUP BY 1", ["mean_price"], MONEY)
def _(spark, sf):
    return orders(spark, sf).groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean_price"))


@register(
    "a8_sum",
    """SELECT l_returnflag, sum(l_quantity) AS quantity, sum(l_quantity * (1 - l_discount)) AS net_quantity
FROM lineitem GROUP BY 1""",
    ["net_quantity"],
    MONEY,
)
def _(spark, sf):
    net = F.sum(F.col("l_quantity") * (1 - F.col("l_discount")))
    return lineitem(spark, sf).groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("quantity"), net.alias("net_quantity")
    )


@register(
    "a9_ratio_of_sums",
    """SELECT l_linestatus, sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS unit_price,
       sum(l_extendedprice) / nullif(sum(l_quantity - l_quantity), 0) AS guarded FROM lineitem GROUP BY 1""",
    ["unit_price"],
    MONEY,
)
def _(spark, sf):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return lineitem(spark, sf).groupBy("l_linestatus").agg(
        aggregates.ratio_of_sums(price, quantity).alias("unit_price"),
        aggregates.ratio_of_sums(price, quantity - quantity).alias("guarded"),
    )


@register(
    "a10_global",
    "SELECT count(*) AS n, avg(value) AS mean_value, max(value) AS top_value FROM events",
    ["mean_value"],
    2**20,
)
def _(spark, sf):
    return feeds.events(spark, sf).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("top_value")
    )


@register(
    "a11_group_by_expression",
    """SELECT 500 * floor(c_acctbal / 500) AS bin_start, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS kind,
       count(*) AS n FROM customer GROUP BY 1, 2""",
)
def _(spark, sf):
    balance = F.col("c_acctbal")
    kind = F.when(balance < 0, F.lit("debt")).otherwise(F.lit("credit"))
    return customer(spark, sf).groupBy(floor_bin(balance, 500).alias("bin_start"), kind.alias("kind")).agg(
        F.count("*").alias("n")
    )


@register(
    "a12_multi_key",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, o_orderstatus,
       count(*) AS n FROM orders GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    return orders(spark, sf).groupBy(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderstatus"
    ).agg(F.count("*").alias("n"))


@register("a13_distinct", "SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select(hour_start(F.col("ts")).alias("hour")).distinct()


@register(
    "a14_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(spark, sf):
    placed = orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return aggregates.latest_per_key(placed, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@register(
    "a14_latest_price_version",
    with_feeds(
        "prices",
        """SELECT zone, date_trunc('hour', ts_utc) AS ts_utc, max(ingestion_ts) AS ingestion_ts,
       arg_max(price_per_mwh, ingestion_ts) AS price_per_mwh FROM prices GROUP BY 1, 2""",
    ),
)
def _(spark, sf):
    versions = feeds.prices(spark, sf).select(
        "zone", hour_start(F.col("ts_utc")).alias("ts_utc"), "ingestion_ts", "price_per_mwh"
    )
    return aggregates.latest_per_key(versions, ["zone", "ts_utc"], "ingestion_ts")


@register("a15_time_range", "SELECT min(ts) AS first_seen, max(ts) AS last_seen FROM events")
def _(spark, sf):
    return aggregates.time_range(feeds.events(spark, sf), "ts")


@register("a16_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def _(spark, sf):
    return aggregates.shape(lineitem(spark, sf))


_SENSOR_LIST = ", ".join(f"('{s}')" for s in SENSOR_COLUMNS)


@register(
    "a17_entity_counts",
    with_feeds(
        "readings",
        f"""SELECT s.id AS entity_id, count(r.entity_id) AS records, count(r.entity_id) = 0 AS is_empty
FROM (VALUES {_SENSOR_LIST}) AS s(id) LEFT JOIN readings r ON r.entity_id = s.id GROUP BY 1""",
    ),
)
def _(spark, sf):
    return aggregates.entity_counts(feeds.readings(spark, sf), "entity_id", list(SENSOR_COLUMNS))


@register("a18_duplicate_keys", "SELECT o_custkey, count(*) AS occurrences FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return aggregates.duplicate_keys(orders(spark, sf), "o_custkey")


@register("a19_row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    return aggregates.row_count(lineitem(spark, sf))


@register(
    "a20_coverage",
    with_feeds(
        "readings",
        f"""SELECT s.id AS entity_id, s.id IN (SELECT entity_id FROM readings) AS present
FROM (VALUES {_SENSOR_LIST}) AS s(id)""",
    ),
)
def _(spark, sf):
    return aggregates.coverage(feeds.readings(spark, sf), "entity_id", list(SENSOR_COLUMNS))


# -- keys --------------------------------------------------------------------


@register(
    "w1_ordered_key",
    'SELECT row_number() OVER (ORDER BY hour) AS "TimeKey", hour FROM (SELECT DISTINCT date_trunc(\'hour\', ts) AS hour FROM events) h',
)
def _(spark, sf):
    hours = feeds.events(spark, sf).select(hour_start(F.col("ts")).alias("hour")).distinct()
    return keys.calendar_row_number(hours, "hour", "TimeKey")


@register(
    "w2_composite_key",
    with_feeds("fact", 'SELECT "FactKey", "TimeKey", "DeviceKey", "LocationKey" FROM fact'),
)
def _(spark, sf):
    star = marts.star(spark, sf)
    base = gold.fact_base(
        stg_iot=star.stg_iot, stg_weather=star.stg_weather, stg_price=star.stg_price, dim_time=star.dim_time
    )
    rows = gold.attach_versions(base, star.dim_device, star.dim_location)
    order = ["TimeKey", "DeviceKey", "LocationKey"]
    return keys.global_row_number(rows.select(*order), order, "FactKey")


@register(
    "w3_natural_key",
    """SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) AS "CustomerKey", c_custkey FROM customer""",
)
def _(spark, sf):
    named = customer(spark, sf).select("c_mktsegment", "c_name", "c_custkey")
    return keys.surrogate_key(named, ["c_mktsegment", "c_name"], "CustomerKey").select("CustomerKey", "c_custkey")


@register(
    "w4_global_row_number",
    """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem""",
)
def _(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return keys.global_row_number(lineitem(spark, sf).select(*order), order, "row_key", unique=False)


@register(
    "w2_stable_key",
    """SELECT row_number() OVER (ORDER BY c_custkey % 3, c_mktsegment, c_nationkey, c_custkey) AS "CustomerKey", c_custkey
FROM customer""",
)
def _(spark, sf):
    """Three deliveries of customers; later ones are numbered after all earlier ones."""
    customers = feeds.table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    registry, natural = scratch_path(spark, "key-registry"), ["c_mktsegment", "c_nationkey", "c_custkey"]
    for last in range(3):
        keyed = stable_key(customers.filter(F.col("c_custkey") % 3 <= last), natural, "CustomerKey", registry)
    return keyed.select("CustomerKey", "c_custkey")


# -- ordering ----------------------------------------------------------------


@register("o1_sort", "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders ORDER BY o_orderdate, o_orderkey")
def _(spark, sf):
    placed = orders(spark, sf).select("o_orderkey", "o_orderdate", "o_orderpriority")
    return ordering.sort_by(placed, "o_orderdate", "o_orderkey")


@register(
    "o2_mixed_sort",
    "SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders ORDER BY o_orderpriority, o_totalprice DESC",
)
def _(spark, sf):
    placed = orders(spark, sf).select("o_orderpriority", "o_totalprice", "o_orderkey")
    return ordering.sort_by(placed, "o_orderpriority", "-o_totalprice")


@register("o3_sort_by_position", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY 1, 2 DESC, 3")
def _(spark, sf):
    named = customer(spark, sf).select("c_mktsegment", "c_acctbal", "c_custkey")
    return ordering.sort_by_position(named, 1, -2, 3)


@register("o4_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10")
def _(spark, sf):
    return ordering.top(orders(spark, sf).select("o_orderkey", "o_totalprice"), 10, "-o_totalprice", "-o_orderkey")


@register("o5_head", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 3")
def _(spark, sf):
    return ordering.head(feeds.events(spark, sf).select("event_id", "ts"), 3, "ts", "event_id")


@register("o6_dashboard_cap", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5000")
def _(spark, sf):
    return ordering.dashboard_cap(feeds.events(spark, sf).select("event_id", "event_type", "value"), "event_id")


# -- sets --------------------------------------------------------------------


def _hour_frames(spark, sf):
    return [
        feeds.readings(spark, sf).select(hour_start(F.col("last_changed")).alias("hour")),
        feeds.weather(spark, sf).select(hour_start(F.col("last_changed")).alias("hour")),
        feeds.prices(spark, sf).select(hour_start(F.col("ts_utc")).alias("hour")),
    ]


_THREE_HOURS = """SELECT date_trunc('hour', last_changed) AS hour FROM readings {0}
SELECT date_trunc('hour', last_changed) FROM weather {0} SELECT date_trunc('hour', ts_utc) FROM prices"""


@register("u1_union_all", with_feeds("readings weather prices", _THREE_HOURS.format("UNION ALL")))
def _(spark, sf):
    return sets.union_all(*_hour_frames(spark, sf))


@register("u2_union_distinct", with_feeds("readings weather prices", _THREE_HOURS.format("UNION")))
def _(spark, sf):
    return sets.union_distinct(*_hour_frames(spark, sf))


@register(
    "u3_replace_where",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01'
  AND o_orderdate < TIMESTAMP '1999-01-01')
UNION ALL SELECT o_orderkey, 'R', o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
  AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def _(spark, sf):
    placed = orders(spark, sf).withColumn("at", as_instant(F.col("o_orderdate")))
    gone = filters.in_window("at", "1998-01-01", "1999-01-01")
    corrected = placed.filter(gone).withColumn("o_orderstatus", F.lit("R"))
    return sets.replace_where(placed, corrected, gone).select("o_orderkey", "o_orderstatus", "o_totalprice")
