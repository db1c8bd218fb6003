"""Column functions: time, bins, text, conditions, nesting, units."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions import bins, parse, text, time, units
from hearth.plans import exploration, gold, silver
from hearth.plans.access import full_access
from hearth.schemas import PRICE_CURRENCY, PRICE_ZONE, UNKNOWN_CONDITION, WEATHER_ENTITY

from . import feeds, marts
from .entry import Entry
from .feeds import number, wall, with_feeds

ENTRIES: dict[str, Entry] = {}


def register(name: str, sql: str | None, floats=()):
    def add(run):
        ENTRIES[name] = Entry(run, sql, floats)
        return run

    return add


# -- date and time ----------------------------------------------------------


@register("dt1_local_wall", f"SELECT event_id, {wall('ts')} AS local_ts FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select("event_id", time.local_wall(F.col("ts")).alias("local_ts"))


@register("dt2_hour_start", "SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select("event_id", time.hour_start(F.col("ts")).alias("hour_start"))


@register("dt3_local_date", f"SELECT event_id, CAST({wall('ts')} AS DATE) AS local_day FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select("event_id", time.local_date(F.col("ts")).alias("local_day"))


@register(
    "dt4_calendar_parts",
    f"""SELECT event_id, CAST(year(w) AS INTEGER) AS "Year", CAST(month(w) AS INTEGER) AS "Month",
       CAST(day(w) AS INTEGER) AS "Day", CAST(hour(w) AS INTEGER) AS "HourOfDay"
FROM (SELECT event_id, {wall('ts')} AS w FROM events) AS e""",
)
def _(spark, sf):
    parts = time.calendar_parts(time.local_wall(F.col("ts")))
    return feeds.events(spark, sf).select("event_id", *[c.alias(n) for n, c in parts.items()])


@register(
    "dt5_iso_weekday",
    "SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS weekday FROM orders",
)
def _(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    return orders.select("o_orderkey", time.iso_weekday(F.to_date("o_orderdate")).alias("weekday"))


@register(
    "dt6_season",
    """SELECT o_orderkey, CASE month(o_orderdate) WHEN 12 THEN 'Winter' WHEN 1 THEN 'Winter'
       WHEN 2 THEN 'Winter' WHEN 3 THEN 'Spring' WHEN 4 THEN 'Spring' WHEN 5 THEN 'Spring'
       WHEN 6 THEN 'Summer' WHEN 7 THEN 'Summer' WHEN 8 THEN 'Summer' ELSE 'Autumn' END AS season FROM orders""",
)
def _(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    return orders.select("o_orderkey", time.season(F.month("o_orderdate")).alias("season"))


@register("dt7_weekend", "SELECT o_orderkey, isodow(o_orderdate) >= 6 AS is_weekend FROM orders")
def _(spark, sf):
    weekday = time.iso_weekday(F.to_date("o_orderdate"))
    return feeds.table(spark, sf, "orders").select("o_orderkey", time.is_weekend(weekday).alias("is_weekend"))


@register(
    "dt8_peak_hours",
    f"""SELECT event_id, h IN (7, 8, 9, 17, 18, 19) AS peak_set, h >= 7 AND h <= 22 AS peak_range
FROM (SELECT event_id, hour({wall('ts')}) AS h FROM events) AS e""",
)
def _(spark, sf):
    hour = F.hour(time.local_wall(F.col("ts")))
    return feeds.events(spark, sf).select(
        "event_id", time.is_peak(hour).alias("peak_set"), time.is_peak_range(hour).alias("peak_range")
    )


@register(
    "dt9_hour_of_local_day",
    f"""SELECT event_id, timezone('UTC', timezone('Europe/Tallinn', CAST(CAST(w AS DATE) AS TIMESTAMP)))
       + to_hours(CAST(hour(w) AS INTEGER)) AS instant
FROM (SELECT event_id, {wall('ts')} AS w FROM events) AS e""",
)
def _(spark, sf):
    local = time.local_wall(F.col("ts"))
    return feeds.events(spark, sf).select(
        "event_id", time.hour_of_local_day(F.to_date(local), F.hour(local)).alias("instant")
    )


@register(
    "dt10_parse_iso",
    "SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS parsed FROM events",
)
def _(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    garbled = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("at "), iso)).otherwise(iso)
    return feeds.events(spark, sf).select("event_id", time.parse_iso(garbled).alias("parsed"))


@register("dt11_from_epoch", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select(
        "event_id", time.from_epoch(F.unix_timestamp("ts")).alias("at")
    )


@register("dt12_epoch_or_iso", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(spark, sf):
    seconds = F.unix_timestamp("ts")
    mixed = (
        F.when(F.col("event_id") % 3 == 0, seconds.cast("string"))
        .when(F.col("event_id") % 3 == 1, (seconds * 1000).cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )
    return feeds.events(spark, sf).select("event_id", time.from_epoch_or_iso(mixed).alias("at"))


@register(
    "dt13_backfill_cutoff",
    "SELECT event_id, date_trunc('hour', ts) - INTERVAL 1 HOUR AS cutoff FROM events",
)
def _(spark, sf):
    return feeds.events(spark, sf).select("event_id", time.backfill_cutoff(F.col("ts")).alias("cutoff"))


@register(
    "dt14_chunk_ranges",
    """WITH spans AS (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
steps AS (SELECT o_custkey, lo, hi, unnest(range(0, CAST(date_diff('day', lo, hi) AS BIGINT), 90)) AS d FROM spans)
SELECT o_custkey, lo, hi, lo + to_days(CAST(d AS INTEGER)) AS chunk_start,
       least(lo + to_days(CAST(d + 90 AS INTEGER)), hi) AS chunk_end FROM steps""",
)
def _(spark, sf):
    spans = feeds.table(spark, sf, "orders").groupBy("o_custkey").agg(
        time.as_instant(F.min("o_orderdate")).alias("lo"), time.as_instant(F.max("o_orderdate")).alias("hi")
    )
    return time.chunk_ranges(spans, "lo", "hi", 90)


@register(
    "dt15_default_validity",
    with_feeds(
        "locations",
        """SELECT "DeviceLocation", coalesce("ValidFrom", DATE '2000-01-01') AS valid_from,
       coalesce("ValidTo", DATE '9999-12-31') AS valid_to FROM locations""",
    ),
)
def _(spark, sf):
    return feeds.locations(spark, sf).select(
        "DeviceLocation",
        time.valid_from_or_default(F.col("ValidFrom")).alias("valid_from"),
        time.valid_to_or_default(F.col("ValidTo")).alias("valid_to"),
    )


# -- math --------------------------------------------------------------------


@register(
    "m1_floor_bin",
    "SELECT c_custkey, 5 * floor(c_acctbal / 5) AS bin_start, 5 * floor(c_acctbal / 5) + 5 AS bin_end FROM customer",
)
def _(spark, sf):
    start = bins.floor_bin(F.col("c_acctbal"), 5)
    return feeds.table(spark, sf, "customer").select(
        "c_custkey", start.alias("bin_start"), bins.bin_end(start, 5).alias("bin_end")
    )


@register(
    "m2_trunc_bin",
    "SELECT c_custkey, CAST(5 * trunc(trunc(c_acctbal) / 5) AS DOUBLE) + 0 AS bin_start FROM customer",
)
def _(spark, sf):
    start = bins.trunc_bin(F.col("c_acctbal"), 5)
    return feeds.table(spark, sf, "customer").select("c_custkey", start.alias("bin_start"))


@register(
    "m3_floor_price_bin",
    with_feeds(
        "prices",
        """SELECT ts_utc, CAST(0.05 AS DOUBLE) * floor(price_per_mwh / 1000 / CAST(0.05 AS DOUBLE)) AS price_bin
FROM prices UNION ALL
SELECT l_shipdate, CAST(0.05 AS DOUBLE) * floor(l_discount / CAST(0.05 AS DOUBLE)) FROM lineitem""",
    ),
)
def _(spark, sf):
    price = units.mwh_to_kwh_price(F.col("price_per_mwh"))
    spot = feeds.prices(spark, sf).select("ts_utc", bins.floor_bin(price, 0.05).alias("price_bin"))
    lines = feeds.table(spark, sf, "lineitem").select(
        time.as_instant(F.col("l_shipdate")).alias("ts_utc"),
        bins.floor_bin(F.col("l_discount"), 0.05).alias("price_bin"),
    )
    return spot.unionByName(lines)


@register(
    "m4_trunc_price_bin",
    """SELECT l_orderkey, l_linenumber,
       CAST(0.05 AS DOUBLE) * trunc((l_tax - l_discount) / CAST(0.05 AS DOUBLE)) + 0 AS price_bin FROM lineitem""",
)
def _(spark, sf):
    spread = F.col("l_tax") - F.col("l_discount")
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", bins.trunc_bin(spread, 0.05).alias("price_bin")
    )


@register("m5_half_floor", "SELECT c_custkey, floor(c_acctbal * 2) / 2 AS half FROM customer")
def _(spark, sf):
    return feeds.table(spark, sf, "customer").select("c_custkey", bins.half_floor(F.col("c_acctbal")).alias("half"))


@register("m6_round_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def _(spark, sf):
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 2).alias("half")
    )


@register(
    "m7_safe_number",
    with_feeds(
        "readings",
        f"""SELECT last_changed, {number('state')} AS plain, {number("state || 'd'")} AS suffixed,
       {number("state || 'e1'")} AS scaled FROM readings""",
    ),
)
def _(spark, sf):
    state = F.col("state")
    return feeds.readings(spark, sf).select(
        "last_changed",
        parse.safe_number(state).alias("plain"),
        parse.safe_number(F.concat(state, F.lit("d"))).alias("suffixed"),
        parse.safe_number(F.concat(state, F.lit("e1"))).alias("scaled"),
    )


@register(
    "m8_safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem",
)
def _(spark, sf):
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", units.safe_ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio")
    )


# -- text and conditions -----------------------------------------------------


@register("t1_concat", "SELECT c_custkey, c_name || '...' || c_mktsegment AS label FROM customer")
def _(spark, sf):
    label = F.concat("c_name", F.lit(text.RANGE_SEPARATOR), "c_mktsegment")
    return feeds.table(spark, sf, "customer").select("c_custkey", label.alias("label"))


@register(
    "t2_number_text",
    """SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_quantity AS VARCHAR), '[.]0$', '') AS quantity,
       regexp_replace(CAST(l_discount AS VARCHAR), '[.]0$', '') AS discount FROM lineitem""",
)
def _(spark, sf):
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.number_text(F.col("l_quantity")).alias("quantity"),
        text.number_text(F.col("l_discount")).alias("discount"),
    )


@register(
    "t3_range_label",
    """SELECT c_custkey,
       regexp_replace(CAST(floor(c_acctbal * 2) / 2 AS VARCHAR), '[.]0$', '') || '...' ||
       regexp_replace(CAST(floor(c_acctbal * 2) / 2 + 0.5 AS VARCHAR), '[.]0$', '') AS half_range,
       CAST(CAST(floor(c_acctbal / 100) * 100 AS BIGINT) AS VARCHAR) || '...' ||
       CAST(CAST(floor(c_acctbal / 100) * 100 + 100 AS BIGINT) AS VARCHAR) AS hundred_range FROM customer""",
)
def _(spark, sf):
    balance = F.col("c_acctbal")
    return feeds.table(spark, sf, "customer").select(
        "c_custkey",
        text.half_range_label(balance).alias("half_range"),
        text.width_range_label(balance, 100).alias("hundred_range"),
    )


@register("t4_prefix", "SELECT o_orderkey, o_orderpriority LIKE '1-%' AS urgent FROM orders")
def _(spark, sf):
    return feeds.table(spark, sf, "orders").select(
        "o_orderkey", text.has_prefix(F.col("o_orderpriority"), "1-").alias("urgent")
    )


@register(
    "c1_multi_branch",
    """SELECT event_id, CASE WHEN strftime(ts, '%m-%d') IN ('01-01', '12-24', '12-25', '12-26') THEN 'Holiday'
       WHEN isodow(ts) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM events""",
)
def _(spark, sf):
    day = F.to_date("ts")
    new_year, christmas = F.dayofyear(day) == 1, (F.month(day) == 12) & F.dayofmonth(day).isin(24, 25, 26)
    day_type = (
        F.when(new_year | christmas, F.lit("Holiday"))
        .when(time.is_weekend(time.iso_weekday(day)), F.lit("Weekend"))
        .otherwise(F.lit("Weekday"))
    )
    return feeds.events(spark, sf).select("event_id", day_type.alias("day_type"))


@register(
    "c2_int_flag",
    f"SELECT event_id, CAST(hour({wall('ts')}) BETWEEN 7 AND 22 AS INTEGER) AS is_peak FROM events",
)
def _(spark, sf):
    hour = F.hour(time.local_wall(F.col("ts")))
    return feeds.events(spark, sf).select("event_id", text.flag(time.is_peak_range(hour)).alias("is_peak"))


@register(
    "c3_coalesce",
    with_feeds(
        "weather",
        """SELECT last_changed, coalesce(condition_state, 'unknown') AS condition_state,
       coalesce("temperature_C", "dew_point_C") AS any_temperature FROM weather""",
    ),
)
def _(spark, sf):
    return feeds.weather(spark, sf).select(
        "last_changed",
        F.coalesce("condition_state", F.lit(UNKNOWN_CONDITION)).alias("condition_state"),
        F.coalesce("temperature_C", "dew_point_C").alias("any_temperature"),
    )


@register(
    "c4_first_present",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_discount ELSE l_tax END AS first_value
FROM lineitem""",
)
def _(spark, sf):
    even = F.col("l_linenumber") % 2 == 0
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parse.first_present(F.when(even, F.col("l_discount")), F.col("l_tax"), F.lit(-1.0)).alias("first_value"),
    )


@register("c5_mask", "SELECT c_custkey, 'Masked' AS c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return feeds.table(spark, sf, "customer").select("c_custkey", text.mask().alias("c_name"), "c_mktsegment")


# -- nested data -------------------------------------------------------------


@register(
    "n1_attribute_lookup",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS missing
FROM events""",
)
def _(spark, sf):
    return feeds.events(spark, sf).select(
        "event_id",
        parse.json_number(F.col("props"), "k").alias("k"),
        parse.json_number(F.col("props"), "absent").alias("missing"),
    )


@register(
    "n2_to_json",
    """SELECT event_id, '{"event_type":"' || event_type || '","mean":' ||
       coalesce(CAST(CASE WHEN event_id % 3 <> 0 THEN user_id END AS VARCHAR), 'null') ||
       ',"source":"log"}' AS attributes FROM events""",
)
def _(spark, sf):
    fields = F.struct(
        "event_type",
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("mean"),
        F.lit("log").alias("source"),
    )
    return feeds.events(spark, sf).select("event_id", parse.to_json_text(fields).alias("attributes"))


@register(
    "n3_nested_list",
    """SELECT l_orderkey, l_linenumber, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_tax FROM lineitem""",
)
def _(spark, sf):
    lists = F.array(F.array("l_quantity"), F.array("l_discount", "l_tax"))
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.explode(F.flatten(lists)).alias("value")
    )


@register(
    "n4_map_explode",
    """SELECT l_orderkey, l_linenumber, 'rates' AS name, l_discount AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'rates', l_tax FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'amount', l_quantity FROM lineitem""",
)
def _(spark, sf):
    by_name = F.create_map(
        F.lit("rates"), F.array("l_discount", "l_tax"), F.lit("amount"), F.array("l_quantity")
    )
    lines = feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.explode(by_name).alias("name", "values")
    )
    return lines.select("l_orderkey", "l_linenumber", "name", F.explode("values").alias("value"))


@register(
    "n5_parallel_arrays",
    """SELECT l_orderkey, l_linenumber, l_quantity AS amount, l_discount AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice, NULL FROM lineitem""",
)
def _(spark, sf):
    zipped = F.arrays_zip(F.array("l_quantity", "l_extendedprice"), F.array("l_discount"))
    lines = feeds.table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.inline(zipped).alias("amount", "rate"))


# -- projections and units ---------------------------------------------------


@register(
    "p1_rename_weather",
    with_feeds(
        "weather",
        """SELECT last_changed AS timestamp_raw, "temperature_C" AS temperature_c, "dew_point_C" AS dew_point_c,
       humidity_percent AS humidity_perc, cloud_coverage_pct, uv_index,
       "pressure_hPa" * CAST(0.750061683 AS DOUBLE) AS air_pressure_mmhg, wind_bearing_deg AS wind_direction_deg,
       wind_gust_speed_kmh / CAST(3.6 AS DOUBLE) AS wind_gust_speed_ms,
       wind_speed_kmh / CAST(3.6 AS DOUBLE) AS wind_speed_ms, condition_state FROM weather""",
    ),
)
def _(spark, sf):
    return silver.rename_weather(feeds.weather(spark, sf))


@register(
    "p2_hpa_to_mmhg",
    with_feeds("weather", 'SELECT last_changed, "pressure_hPa" * CAST(0.750061683 AS DOUBLE) AS mmhg FROM weather'),
)
def _(spark, sf):
    return feeds.weather(spark, sf).select("last_changed", units.hpa_to_mmhg(F.col("pressure_hPa")).alias("mmhg"))


@register(
    "p3_kmh_to_ms",
    with_feeds(
        "weather",
        """SELECT last_changed, wind_speed_kmh / CAST(3.6 AS DOUBLE) AS speed_ms,
       wind_gust_speed_kmh / CAST(3.6 AS DOUBLE) AS gust_ms FROM weather""",
    ),
)
def _(spark, sf):
    return feeds.weather(spark, sf).select(
        "last_changed",
        units.kmh_to_ms(F.col("wind_speed_kmh")).alias("speed_ms"),
        units.kmh_to_ms(F.col("wind_gust_speed_kmh")).alias("gust_ms"),
    )


@register("p4_mwh_to_kwh_price", with_feeds("prices", "SELECT ts_utc, price_per_mwh / 1000 AS eur_per_kwh FROM prices"))
def _(spark, sf):
    return feeds.prices(spark, sf).select(
        "ts_utc", units.mwh_to_kwh_price(F.col("price_per_mwh")).alias("eur_per_kwh")
    )


@register("p5_w_to_kwh", "SELECT event_id, value / 1000 AS kwh FROM events")
def _(spark, sf):
    return feeds.events(spark, sf).select("event_id", units.w_to_kwh(F.col("value")).alias("kwh"))


@register("p6_cost", "SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 * l_tax AS cost FROM lineitem")
def _(spark, sf):
    return feeds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", units.cost(F.col("l_extendedprice"), F.col("l_tax")).alias("cost")
    )


@register(
    "p7_temp_delta",
    with_feeds("weather", 'SELECT last_changed, "temperature_C" - "dew_point_C" AS delta FROM weather'),
)
def _(spark, sf):
    return feeds.weather(spark, sf).select(
        "last_changed", units.temp_delta(F.col("temperature_C"), F.col("dew_point_C")).alias("delta")
    )


@register(
    "p8_uv_from_radiation",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN round_even(user_id * CAST(2.5 AS DOUBLE) / 25, 0) END AS uv
FROM events""",
)
def _(spark, sf):
    radiation = F.when(F.col("event_id") % 7 != 0, F.col("user_id") * F.lit(2.5))
    return feeds.events(spark, sf).select("event_id", units.uv_from_radiation(radiation).alias("uv"))


MEASURE_NAMES = [name for name in gold.MEASURES if name != "WeatherCondition"]


@register("p9_fact_projection", with_feeds("fact_base", "SELECT * FROM fact_base"), MEASURE_NAMES)
def _(spark, sf):
    star = marts.star(spark, sf)
    return gold.fact_base(
        stg_iot=star.stg_iot, stg_weather=star.stg_weather, stg_price=star.stg_price, dim_time=star.dim_time
    )


@register("p10_select_all", with_feeds("fact", "SELECT * FROM fact"), MEASURE_NAMES)
def _(spark, sf):
    return full_access(marts.star(spark, sf).fact)


@register(
    "p11_constants",
    """SELECT event_id, 'EE' AS zone, 'EUR' AS currency, 'weather.forecast_home' AS entity_id,
       'unknown' AS condition_state FROM events""",
)
def _(spark, sf):
    return feeds.events(spark, sf).select(
        "event_id",
        F.lit(PRICE_ZONE).alias("zone"),
        F.lit(PRICE_CURRENCY).alias("currency"),
        F.lit(WEATHER_ENTITY).alias("entity_id"),
        F.lit(UNKNOWN_CONDITION).alias("condition_state"),
    )


@register(
    "p12_alias_reuse",
    with_feeds("dim_time", 'SELECT "HourTs", "Month", "Season", "DayOfWeek", "IsWeekend", "HourOfDay", "IsPeakHour" FROM dim_time'),
)
def _(spark, sf):
    star = marts.star(spark, sf)
    hours = gold.needed_hours(star.stg_iot, star.stg_weather, star.stg_price)
    return gold.calendar_columns(hours).select(
        "HourTs", "Month", "Season", "DayOfWeek", "IsWeekend", "HourOfDay", "IsPeakHour"
    )


@register(
    "p13_sensor_slice",
    with_feeds(
        "readings",
        "SELECT last_changed AS timestamp, state AS heat_pump_power FROM readings WHERE entity_id = 'sensor.ohksoojus_power'",
    ),
)
def _(spark, sf):
    return exploration.sensor_slice(feeds.readings(spark, sf), "sensor.ohksoojus_power", "heat_pump_power")
