"""Sensor, weather, price and dimension feeds derived from the supplied tables.

Every feed exists twice: as a DataFrame and as a SQL common table expression
for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.functions.time import as_instant
from hearth.plans import calendar
from hearth.schemas import PRICE_CURRENCY, PRICE_ZONE

SENSOR_OF_TYPE = {
    "click": "sensor.ohksoojus_power",
    "view": "sensor.tempniiskuslauaall_temperature",
    "error": "sensor.0xa4c138cdc6eff777_power",
    "signup": "sensor.tempniiskuslauaall_humidity",
}
OTHER_SENSOR = "sensor.0xa4c138cdc6eff777_voltage"
DEVICE_DAYS = 10
LOCATION_DAYS = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", as_instant(F.col("ts")))


def sensor_id() -> Column:
    chain = None
    for event_type, sensor in SENSOR_OF_TYPE.items():
        match = F.col("event_type") == event_type
        chain = F.when(match, F.lit(sensor)) if chain is None else chain.when(match, F.lit(sensor))
    return chain.otherwise(F.lit(OTHER_SENSOR))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor log in the shape of the bronze table."""
    state = (
        F.when(F.col("event_id") % 50 == 0, F.lit("unavailable"))
        .when(F.col("event_type") == "view", F.format_string("%.4f", 10 + F.col("value") / 4))
        .otherwise(F.format_string("%.2f", F.col("value")))
    )
    return events(spark, sf_dir).select(
        F.col("ts").alias("ingestion_ts"),
        sensor_id().alias("entity_id"),
        state.alias("state"),
        F.col("ts").alias("last_changed"),
        F.col("props").alias("attributes"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations in the shape of the bronze table."""
    e = events(spark, sf_dir).filter(F.col("event_type").isin("view", "click"))
    value, event_id, user_id = F.col("value"), F.col("event_id"), F.col("user_id")
    return e.select(
        F.col("ts").alias("ingestion_ts"),
        F.lit("weather.forecast_home").alias("entity_id"),
        F.when(event_id % 11 != 0, F.col("event_type")).alias("condition_state"),
        F.col("ts").alias("last_changed"),
        F.when(event_id % 37 != 0, value / 10 - 10).alias("temperature_C"),
        (F.lit(980) + user_id / 5).alias("pressure_hPa"),
        (user_id % 101).cast("double").alias("humidity_percent"),
        value.alias("wind_speed_kmh"),
        ((event_id * 7) % 361).cast("double").alias("wind_bearing_deg"),
        (event_id % 101).cast("double").alias("cloud_coverage_pct"),
        (value / 10 - 15).alias("dew_point_C"),
        (user_id % 12).cast("double").alias("uv_index"),
        (value * 1.5).alias("wind_gust_speed_kmh"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Electricity prices in the shape of the bronze table; some are negative."""
    return events(spark, sf_dir).filter(F.col("event_type") == "purchase").select(
        F.col("ts").alias("ingestion_ts"),
        F.col("ts").alias("ts_utc"),
        F.lit(PRICE_ZONE).alias("zone"),
        F.lit(PRICE_CURRENCY).alias("currency"),
        (F.col("value") - 20).alias("price_per_mwh"),
    )


def _blocks(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """One row per block of days that has events, with its largest value."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    blocks = events(spark, sf_dir).groupBy(F.floor(day / days).cast("int").alias("blk"))
    blocks = blocks.agg(F.max("value").alias("top_value"))
    ends = blocks.agg(F.struct(F.min("blk").alias("lo"), F.max("blk").alias("hi")).alias("ends")).scalar()
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("blk") * days)
    return blocks.select(
        "blk",
        "top_value",
        start.alias("since"),
        F.date_add(start, days - 1).alias("until"),
        (F.col("blk") == ends.getField("lo")).alias("is_first"),
        (F.col("blk") == ends.getField("hi")).alias("is_last"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device swap every ten days; odd blocks also have an unnamed draft row."""
    even = F.col("blk") % 2 == 0
    blocks = _blocks(spark, sf_dir, DEVICE_DAYS)
    drafts = blocks.withColumn("draft", F.explode(F.when(even, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))))
    model = F.when(even, F.lit("Altherma_3_RF_08kW")).otherwise(F.lit("Ecodan_PUZ-WM60VHA"))
    return drafts.select(
        F.when(even, F.lit("Daikin")).otherwise(F.lit("Mitsubishi Electric")).alias("Brand"),
        F.when(~F.col("draft"), model).alias("Model"),
        F.when(even, F.lit(20.0)).otherwise(F.lit(10.0)).alias("MinPower"),
        F.col("top_value").alias("MaxPower"),
        F.col("since").alias("InstallationDate"),
        F.when(~F.col("is_last"), F.col("until")).alias("ValidTo"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A move every fifteen days, with open ends on both sides."""
    even = F.col("blk") % 2 == 0
    return _blocks(spark, sf_dir, LOCATION_DAYS).select(
        F.when(even, F.lit("Tallinn")).otherwise(F.lit("Tartu")).alias("DeviceLocation"),
        F.when(even, F.lit("Tallinn-Harku")).otherwise(F.lit("Tartu-Toravere")).alias("ClosestWeatherStation"),
        F.when(even, F.lit("EE_North")).otherwise(F.lit("EE_South")).alias("PricingRegion"),
        F.when(~F.col("is_first"), F.col("since")).alias("ValidFrom"),
        F.when(~F.col("is_last"), F.col("until")).alias("ValidTo"),
    )


def holidays(spark: SparkSession) -> DataFrame:
    return calendar.holidays(spark, 2020, 2040)


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity of a customer's state, from one order day to the next."""
    days = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("valid_from"))
        .agg(F.max("o_totalprice").alias("level"))
    )
    # one row per customer and day, so a window holds at most a calendar of days
    following = F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from"))
    return days.select(
        F.col("o_custkey").alias("custkey"),
        "valid_from",
        F.coalesce(F.date_sub(following, 1), F.lit("9999-12-31").cast("date")).alias("valid_to"),
        "level",
    )


# --------------------------------------------------------------------------
# The same feeds and the models over them, as SQL for the oracle.

_HOUR = "date_trunc('hour', {})"
_WALL = "timezone('Europe/Tallinn', timezone('UTC', {}))"
NUMERIC = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def wall(col: str) -> str:
    return _WALL.format(col)


def number(col: str) -> str:
    return f"CASE WHEN regexp_matches({col}, '{NUMERIC}') THEN TRY_CAST({col} AS DOUBLE) END"


SENSOR_CASE = (
    "CASE event_type "
    + " ".join(f"WHEN '{t}' THEN '{s}'" for t, s in SENSOR_OF_TYPE.items())
    + f" ELSE '{OTHER_SENSOR}' END"
)

# Sensor of each hourly average.
_SENSOR_AVERAGES = {
    "heat_pump_power_avg": "sensor.ohksoojus_power",
    "boiler_power_avg": "sensor.0xa4c138cdc6eff777_power",
    "air_drier_power_avg": "sensor.ohukuivati_power",
    "living_room_hum_abs_avg": "sensor.abshumidkuu2_absolute_humidity",
    "living_room_hum_perc_avg": "sensor.tempniiskuslauaall_humidity",
    "wc_hum_abs_avg": "sensor.indoor_absolute_humidity",
    "living_room_temp_avg": "sensor.tempniiskuslauaall_temperature",
    "wc_temp_avg": "sensor.indoor_outdoor_meter_3866",
    "boiler_voltage_avg": "sensor.0xa4c138cdc6eff777_voltage",
}

_BLOCKS = """
SELECT blk, top_value, DATE '2024-01-01' + CAST(blk * {days} AS INTEGER) AS since,
       DATE '2024-01-01' + CAST(blk * {days} + {days} - 1 AS INTEGER) AS until,
       blk = min(blk) OVER () AS is_first, blk = max(blk) OVER () AS is_last
FROM (SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / {days}) AS INTEGER) AS blk,
             max(value) AS top_value
      FROM events GROUP BY 1) AS b
"""

_CTES: dict[str, tuple[list[str], str]] = {
    "readings": (
        [],
        f"""SELECT ts AS ingestion_ts, {SENSOR_CASE} AS entity_id,
       CASE WHEN event_id % 50 = 0 THEN 'unavailable'
            WHEN event_type = 'view' THEN printf('%.4f', 10 + value / 4)
            ELSE printf('%.2f', value) END AS state,
       ts AS last_changed, props AS attributes FROM events""",
    ),
    "weather": (
        [],
        """SELECT ts AS ingestion_ts, 'weather.forecast_home' AS entity_id,
       CASE WHEN event_id % 11 <> 0 THEN event_type END AS condition_state, ts AS last_changed,
       CASE WHEN event_id % 37 <> 0 THEN value / 10 - 10 END AS "temperature_C",
       980 + user_id / 5 AS "pressure_hPa", CAST(user_id % 101 AS DOUBLE) AS humidity_percent,
       value AS wind_speed_kmh, CAST((event_id * 7) % 361 AS DOUBLE) AS wind_bearing_deg,
       CAST(event_id % 101 AS DOUBLE) AS cloud_coverage_pct, value / 10 - 15 AS "dew_point_C",
       CAST(user_id % 12 AS DOUBLE) AS uv_index, value * CAST(1.5 AS DOUBLE) AS wind_gust_speed_kmh
FROM events WHERE event_type IN ('view', 'click')""",
    ),
    "prices": (
        [],
        """SELECT ts AS ingestion_ts, ts AS ts_utc, 'EE' AS zone, 'EUR' AS currency,
       value - 20 AS price_per_mwh FROM events WHERE event_type = 'purchase'""",
    ),
    "device_blocks": ([], _BLOCKS.format(days=DEVICE_DAYS)),
    "location_blocks": ([], _BLOCKS.format(days=LOCATION_DAYS)),
    "devices": (
        ["device_blocks"],
        """SELECT CASE WHEN blk % 2 = 0 THEN 'Daikin' ELSE 'Mitsubishi Electric' END AS "Brand",
       CASE WHEN draft = 1 THEN NULL WHEN blk % 2 = 0 THEN 'Altherma_3_RF_08kW'
            ELSE 'Ecodan_PUZ-WM60VHA' END AS "Model",
       CAST(CASE WHEN blk % 2 = 0 THEN 20 ELSE 10 END AS DOUBLE) AS "MinPower", top_value AS "MaxPower",
       since AS "InstallationDate", CASE WHEN NOT is_last THEN until END AS "ValidTo"
FROM device_blocks, (VALUES (0), (1)) AS d(draft) WHERE draft = 0 OR blk % 2 <> 0""",
    ),
    "locations": (
        ["location_blocks"],
        """SELECT CASE WHEN blk % 2 = 0 THEN 'Tallinn' ELSE 'Tartu' END AS "DeviceLocation",
       CASE WHEN blk % 2 = 0 THEN 'Tallinn-Harku' ELSE 'Tartu-Toravere' END AS "ClosestWeatherStation",
       CASE WHEN blk % 2 = 0 THEN 'EE_North' ELSE 'EE_South' END AS "PricingRegion",
       CASE WHEN NOT is_first THEN since END AS "ValidFrom",
       CASE WHEN NOT is_last THEN until END AS "ValidTo" FROM location_blocks""",
    ),
    "holidays": (
        [],
        """SELECT CAST(d AS DATE) AS day FROM (VALUES
       ('2023-12-24'), ('2023-12-25'), ('2023-12-26'), ('2024-01-01'), ('2024-02-24'), ('2024-03-29'),
       ('2024-03-31'), ('2024-05-01'), ('2024-05-19'), ('2024-06-23'), ('2024-06-24'), ('2024-08-20'),
       ('2024-12-24'), ('2024-12-25'), ('2024-12-26')) AS h(d)""",
    ),
    "stg_iot": (
        ["readings"],
        f"SELECT {_HOUR.format('last_changed')} AS hour_start, "
        + ", ".join(
            f"avg(num) FILTER (WHERE entity_id = '{s}') AS {name}" for name, s in _SENSOR_AVERAGES.items()
        )
        + f" FROM (SELECT *, {number('state')} AS num FROM readings) AS r GROUP BY 1",
    ),
    "stg_weather": (
        ["weather"],
        """SELECT date_trunc('hour', last_changed) AS timestamp, avg("temperature_C") AS temperature_c,
       avg("dew_point_C") AS dew_point_c, avg(humidity_percent) AS humidity_perc,
       avg(cloud_coverage_pct) AS cloud_coverage_pct, avg(uv_index) AS uv_index,
       avg("pressure_hPa" * CAST(0.750061683 AS DOUBLE)) AS air_pressure_mmhg,
       avg(wind_bearing_deg) AS wind_direction_deg,
       avg(wind_gust_speed_kmh / CAST(3.6 AS DOUBLE)) AS wind_gust_speed_ms,
       avg(wind_speed_kmh / CAST(3.6 AS DOUBLE)) AS wind_speed_ms,
       arg_max(condition_state, last_changed) AS condition_state
FROM weather GROUP BY 1""",
    ),
    "stg_price": (
        ["prices"],
        """SELECT date_trunc('hour', ts_utc) AS timestamp,
       avg(price_per_mwh) / CAST(1000.0 AS DOUBLE) AS price_eur_per_kwh FROM prices GROUP BY 1""",
    ),
    "dim_device": (
        ["devices"],
        """SELECT row_number() OVER (ORDER BY "Brand", "Model", "InstallationDate",
              coalesce("ValidTo", DATE '9999-12-31')) AS "DeviceKey", "Brand", "Model", "MinPower", "MaxPower",
       "InstallationDate", coalesce("ValidTo", DATE '9999-12-31') AS "ValidTo"
FROM devices WHERE "Brand" IS NOT NULL AND "Model" IS NOT NULL""",
    ),
    "dim_location": (
        ["locations"],
        """SELECT row_number() OVER (ORDER BY "DeviceLocation", "ClosestWeatherStation", "PricingRegion",
              coalesce("ValidFrom", DATE '2000-01-01'), coalesce("ValidTo", DATE '9999-12-31')) AS "LocationKey",
       "DeviceLocation", "ClosestWeatherStation", "PricingRegion",
       coalesce("ValidFrom", DATE '2000-01-01') AS "ValidFrom",
       coalesce("ValidTo", DATE '9999-12-31') AS "ValidTo"
FROM locations WHERE "DeviceLocation" IS NOT NULL AND "ClosestWeatherStation" IS NOT NULL
  AND "PricingRegion" IS NOT NULL""",
    ),
    "hours": (
        ["stg_iot", "stg_weather", "stg_price"],
        """SELECT hour_start AS "HourTs" FROM stg_iot UNION SELECT timestamp FROM stg_weather
UNION SELECT timestamp FROM stg_price""",
    ),
    "dim_time": (
        ["hours", "holidays"],
        f"""SELECT row_number() OVER (ORDER BY "HourTs") AS "TimeKey", CAST(w AS DATE) AS "FullDate",
       CAST(year(w) AS INTEGER) AS "Year", CAST(month(w) AS INTEGER) AS "Month", CAST(day(w) AS INTEGER) AS "Day",
       CAST(isodow(w) AS INTEGER) AS "DayOfWeek", CAST(hour(w) AS INTEGER) AS "HourOfDay",
       CASE WHEN month(w) IN (12, 1, 2) THEN 'Winter' WHEN month(w) IN (3, 4, 5) THEN 'Spring'
            WHEN month(w) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS "Season",
       CAST(w AS DATE) IN (SELECT day FROM holidays) AS "IsHoliday", isodow(w) IN (6, 7) AS "IsWeekend",
       hour(w) IN (7, 8, 9, 17, 18, 19) AS "IsPeakHour", "HourTs"
FROM (SELECT *, {wall('"HourTs"')} AS w FROM hours) AS t""",
    ),
    "fact_base": (
        ["stg_iot", "stg_weather", "stg_price", "dim_time"],
        """SELECT i.hour_start, t."TimeKey", p.price_eur_per_kwh AS "ElectricityPrice",
       i.heat_pump_power_avg AS "ASHP_Power", i.boiler_power_avg AS "Boiler_Power",
       i.air_drier_power_avg AS "Air_Drier_Power", i.boiler_voltage_avg AS "Boiler_Voltage",
       i.living_room_temp_avg AS "IndoorTemp", i.living_room_hum_perc_avg AS "IndoorHumidityPerc",
       i.living_room_hum_abs_avg AS "IndoorHumidityAbs", i.wc_hum_abs_avg AS "WC_HumidityAbs",
       i.wc_temp_avg AS "WC_Temp", w.temperature_c AS "OutdoorTemp", w.dew_point_c AS "DewPoint",
       w.humidity_perc AS "OutdoorHumidityPerc", w.cloud_coverage_pct AS "CloudCoverage",
       w.uv_index AS "UV_Index", w.air_pressure_mmhg AS "AirPressure_mmHg",
       w.wind_direction_deg AS "WindDir", w.wind_gust_speed_ms AS "WindGustSpeed_ms",
       w.wind_speed_ms AS "WindSpeed_ms", w.condition_state AS "WeatherCondition"
FROM stg_iot i JOIN dim_time t ON i.hour_start = t."HourTs"
LEFT JOIN stg_weather w ON i.hour_start = w.timestamp
LEFT JOIN stg_price p ON i.hour_start = p.timestamp""",
    ),
    "fact": (
        ["fact_base", "dim_device", "dim_location"],
        f"""SELECT row_number() OVER (ORDER BY "TimeKey", "DeviceKey", "LocationKey") AS "FactKey",
       "TimeKey", "DeviceKey", "LocationKey", b.* EXCLUDE (hour_start, "TimeKey")
FROM fact_base b CROSS JOIN dim_device d CROSS JOIN dim_location l
WHERE CAST({wall('b.hour_start')} AS DATE) BETWEEN coalesce(d."InstallationDate", DATE '2000-01-01') AND d."ValidTo"
  AND CAST({wall('b.hour_start')} AS DATE) BETWEEN l."ValidFrom" AND l."ValidTo" """,
    ),
    "limited": (
        ["fact"],
        """SELECT "FactKey", "TimeKey", "DeviceKey", "LocationKey",
       regexp_replace(CAST(floor("ElectricityPrice" * 2) / 2 AS VARCHAR), '[.]0$', '') || '...' ||
       regexp_replace(CAST(floor("ElectricityPrice" * 2) / 2 + 0.5 AS VARCHAR), '[.]0$', '')
         AS "ElectricityPrice_Range",
       CAST(CAST(floor("ASHP_Power" / 100) * 100 AS BIGINT) AS VARCHAR) || '...' ||
       CAST(CAST(floor("ASHP_Power" / 100) * 100 + 100 AS BIGINT) AS VARCHAR) AS "ASHP_Power_Range",
       "Boiler_Power", "Air_Drier_Power", "Boiler_Voltage", "IndoorTemp", "IndoorHumidityPerc",
       "IndoorHumidityAbs", "WC_HumidityAbs", 'Masked' AS "WC_Temp", "OutdoorTemp", "DewPoint",
       "OutdoorHumidityPerc", "CloudCoverage", "UV_Index", "AirPressure_mmHg", "WindDir",
       "WindGustSpeed_ms", "WindSpeed_ms", "WeatherCondition" FROM fact""",
    ),
    "versions": (
        [],
        """SELECT o_custkey AS custkey, day AS valid_from,
       coalesce(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1, DATE '9999-12-31') AS valid_to, level
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS level
      FROM orders GROUP BY 1, 2) AS d""",
    ),
}


def with_feeds(names: str, body: str, *, once: bool = False) -> str:
    """``body`` below the common table expressions it needs, in order.

    With ``once``, repeated rows of the three logs count once.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names.split():
        visit(name)
    distinct = {"readings", "weather", "prices"} if once else set()
    texts = {n: f"SELECT DISTINCT * FROM ({_CTES[n][1]}) AS rows" if n in distinct else _CTES[n][1] for n in ordered}
    ctes = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in texts.items())
    return f"WITH {ctes}\n{body}"


def outer_merge_sql(columns: dict[str, str], shown: list[str] | None = None) -> str:
    """Full outer joins of one slice of ``readings`` per sensor."""
    slices = [
        f"(SELECT last_changed AS t, state FROM readings WHERE entity_id = '{sensor}') AS s{i}"
        for i, sensor in enumerate(columns)
    ]
    joined = slices[0]
    for i, one in enumerate(slices[1:], start=1):
        before = ", ".join(f"s{j}.t" for j in range(i))
        joined += f"\nFULL JOIN {one} ON coalesce({before}, NULL) = s{i}.t"
    names = [(f"s{i}.state AS {name}") for i, name in enumerate(columns.values()) if shown is None or name in shown]
    times = ", ".join(f"s{i}.t" for i in range(len(slices)))
    return f"SELECT coalesce({times}) AS timestamp, {', '.join(names)}\nFROM {joined}"
