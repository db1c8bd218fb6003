"""The analytic questions over the stored star schema."""

from __future__ import annotations

from hearth.plans import analytics
from hearth.plans.access import full_access, limited_access
from hearth.plans.exploration import SERIES_GROUPS, series, wide_raw
from hearth.schemas import RAW_COLUMNS

from . import feeds, marts
from .entry import Entry
from .feeds import outer_merge_sql, with_feeds

ENTRIES: dict[str, Entry] = {}

MODEL = "Altherma_3_RF_08kW"
JOINED = 'fact f JOIN dim_device dd ON f."DeviceKey" = dd."DeviceKey"'
STARRED = JOINED + ' JOIN dim_time dt ON f."TimeKey" = dt."TimeKey"'
OUTDOOR = '"OutdoorTemp" >= -25 AND "OutdoorTemp" < 30 AND "ASHP_Power" IS NOT NULL'
PRICED = '"ElectricityPrice" IS NOT NULL AND "ASHP_Power" IS NOT NULL'
HEATED = '"IndoorTemp" BETWEEN 15 AND 25 AND "OutdoorTemp" IS NOT NULL AND "ASHP_Power" IS NOT NULL'
FLOOR_TEMP = '5 * floor("OutdoorTemp" / 5)'
TRUNC_TEMP = '5 * trunc(trunc("OutdoorTemp") / 5) + 0'
FLOOR_PRICE = 'CAST(0.05 AS DOUBLE) * floor("ElectricityPrice" / CAST(0.05 AS DOUBLE))'
TRUNC_PRICE = 'CAST(0.05 AS DOUBLE) * trunc("ElectricityPrice" / CAST(0.05 AS DOUBLE)) + 0'
WIDE_PEAK = 'CAST("HourOfDay" BETWEEN 7 AND 22 AS INTEGER)'
WEEKEND_FLAG = 'CAST("DayOfWeek" IN (6, 7) AS INTEGER)'


def _ask(question, **options):
    def run(spark, sf):
        star = marts.star(spark, sf)
        return question(star.fact, star.dim_time, star.dim_device, **options)

    return run


def _add(name, question, sql, floats=(), needs="fact dim_device dim_time", **options):
    ENTRIES[name] = Entry(_ask(question, **options), with_feeds(needs, sql), floats)


def _power_bin(bin_sql, extra=""):
    return f"""SELECT bin_start, bin_start + 5 AS bin_end, avg("ASHP_Power") AS avg_power_w, count(*) AS hours
FROM (SELECT {bin_sql} AS bin_start, f."ASHP_Power" FROM {JOINED} WHERE {OUTDOOR}{extra}) AS b GROUP BY 1"""


_add("y1a_power_by_outdoor_bin", analytics.y1a, _power_bin(FLOOR_TEMP), ["avg_power_w"])
_add(
    "y1a_power_by_outdoor_bin_model",
    analytics.y1a,
    _power_bin(FLOOR_TEMP, f""" AND dd."Model" = '{MODEL}'"""),
    ["avg_power_w"],
    model=MODEL,
)
_add("y1b_power_by_outdoor_bin_trunc", analytics.y1b, _power_bin(TRUNC_TEMP), ["avg_power_w"])


def _extract(weekend):
    return f"""SELECT "FullDate", "HourOfDay", {weekend} AS "IsWeekend", "OutdoorTemp", "IndoorTemp",
       "IndoorTemp" - "OutdoorTemp" AS "TempDelta", "ASHP_Power" AS power_w,
       "ASHP_Power" / 1000 AS energy_kwh_per_hr FROM {STARRED} WHERE {HEATED}"""


EXTRACT_FLOATS = ["OutdoorTemp", "IndoorTemp", "TempDelta", "power_w", "energy_kwh_per_hr"]
_add("y2a_model_extract", analytics.y2a, _extract('"IsWeekend"'), EXTRACT_FLOATS)
_add("y2b_model_extract_flags", analytics.y2b, _extract(WEEKEND_FLAG), EXTRACT_FLOATS)


def _watts(low, high):
    return f"""SELECT sum("ASHP_Power") / nullif(sum("IndoorTemp" - "OutdoorTemp"), 0) AS "watts_per_C",
       count(*) AS hours_used FROM {JOINED} WHERE "IndoorTemp" BETWEEN {low} AND {high}
  AND "OutdoorTemp" IS NOT NULL AND "IndoorTemp" > "OutdoorTemp" AND "ASHP_Power" IS NOT NULL"""


_add("y3a_watts_per_degree", analytics.y3a, _watts(19.5, 20.5), ["watts_per_C"])
_add("y3b_watts_per_degree_wide", analytics.y3b, _watts(20, 23), ["watts_per_C"])


def _price_bin(bin_sql):
    return f"""SELECT {bin_sql} AS price_bin_eur, avg("ElectricityPrice") AS avg_price_in_bin,
       avg("ASHP_Power") AS avg_power_w, sum("ASHP_Power") / 1000 AS energy_kwh,
       sum("ASHP_Power" / 1000 * "ElectricityPrice") AS bucket_cost, count(*) AS hours
FROM {STARRED} WHERE {PRICED} GROUP BY 1"""


PRICE_FLOATS = ["avg_price_in_bin", "avg_power_w", "energy_kwh", "bucket_cost"]
_add("y4a_cost_by_price_bin", analytics.y4a, _price_bin(FLOOR_PRICE), PRICE_FLOATS)
_add("y4b_cost_by_price_bin_trunc", analytics.y4b, _price_bin(TRUNC_PRICE), PRICE_FLOATS)


def _costs(peak, weekend, holiday):
    return f"""SELECT "FullDate", "HourOfDay", {peak} AS "IsPeakHour", {weekend} AS "IsWeekend",
       {holiday} AS "IsHoliday", "ElectricityPrice" AS price_eur_per_kwh, "ASHP_Power" AS power_w,
       "ASHP_Power" / 1000 AS energy_kwh, "ASHP_Power" / 1000 * "ElectricityPrice" AS cost_eur
FROM {STARRED} WHERE {PRICED}"""


COST_FLOATS = ["price_eur_per_kwh", "power_w", "energy_kwh", "cost_eur"]
_add("y5a_hourly_cost", analytics.y5a, _costs('"IsPeakHour"', '"IsWeekend"', '"IsHoliday"'), COST_FLOATS)
_add("y5b_hourly_cost_flags", analytics.y5b, _costs(WIDE_PEAK, WEEKEND_FLAG, "0"), COST_FLOATS)


def _day_type(day_type, peak):
    return f"""SELECT {day_type} AS day_type, {peak} AS "IsPeakHour", sum("ASHP_Power") / 1000 AS energy_kwh,
       sum("ASHP_Power" / 1000 * "ElectricityPrice") AS cost_eur,
       avg("ElectricityPrice") AS avg_price_eur_per_kwh, count(*) AS hours
FROM {STARRED} WHERE {PRICED} GROUP BY 1, 2"""


DAY_FLOATS = ["energy_kwh", "cost_eur", "avg_price_eur_per_kwh"]
_add(
    "y6a_daytype_peak",
    analytics.y6a,
    _day_type("CASE WHEN \"IsHoliday\" THEN 'Holiday' WHEN \"IsWeekend\" THEN 'Weekend' ELSE 'Weekday' END", '"IsPeakHour"'),
    DAY_FLOATS,
)
_add(
    "y6b_daytype_peak_flags",
    analytics.y6b,
    _day_type("CASE WHEN \"DayOfWeek\" IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END", WIDE_PEAK),
    DAY_FLOATS,
)


def _monthly(bin_sql):
    return f"""SELECT "Year", "Month", bin_start, bin_start + 5 AS bin_end, sum("ASHP_Power") / 1000 AS energy_kwh,
       count(*) AS hours
FROM (SELECT "Year", "Month", {bin_sql} AS bin_start, "ASHP_Power" FROM {STARRED} WHERE {OUTDOOR}) AS b
GROUP BY 1, 2, 3"""


_add("y7a_energy_by_month_bin", analytics.y7a, _monthly(FLOOR_TEMP), ["energy_kwh"])
_add("y7b_energy_by_month_bin_trunc", analytics.y7b, _monthly(TRUNC_TEMP), ["energy_kwh"])


def _below(extra=""):
    return f"""SELECT "Year", "Month", "Day", count(*) AS hours_below_min FROM {STARRED}
WHERE "ASHP_Power" IS NOT NULL AND "MinPower" IS NOT NULL AND "ASHP_Power" < "MinPower"{extra} GROUP BY 1, 2, 3"""


_add("y8a_hours_below_minimum", analytics.y8a, _below(f""" AND dd."Model" = '{MODEL}'"""), model=MODEL)
_add("y8b_hours_below_minimum_all", analytics.y8b, _below())


def _last(view, price, power):
    return f"""SELECT v."FactKey", v."{price}", v."WC_Temp", v."{power}", t."IsHoliday", t."Month", t."Day",
       t."HourOfDay", t."IsWeekend", d."Brand", d."Model", l."DeviceLocation", l."PricingRegion"
FROM {view} v JOIN dim_time t ON v."TimeKey" = t."TimeKey" JOIN dim_device d ON v."DeviceKey" = d."DeviceKey"
JOIN dim_location l ON v."LocationKey" = l."LocationKey"
ORDER BY v."TimeKey" DESC, v."FactKey" DESC LIMIT 10"""


def _y9(spark, sf):
    star = marts.star(spark, sf)
    return analytics.y9(full_access(star.fact), star.dim_time, star.dim_device, star.dim_location)


def _y10(spark, sf):
    star = marts.star(spark, sf)
    return analytics.y10(limited_access(star.fact), star.dim_time, star.dim_device, star.dim_location)


ENTRIES["y9_last_rows_full"] = Entry(
    _y9,
    with_feeds("fact dim_time dim_device dim_location", _last("fact", "ElectricityPrice", "ASHP_Power")),
    ["ElectricityPrice", "ASHP_Power"],
)
ENTRIES["y10_last_rows_limited"] = Entry(
    _y10,
    with_feeds(
        "limited dim_time dim_device dim_location", _last("limited", "ElectricityPrice_Range", "ASHP_Power_Range")
    ),
)
ENTRIES["y11_price_series"] = Entry(
    lambda spark, sf: analytics.y11(marts.star(spark, sf).stg_price),
    with_feeds("stg_price", "SELECT timestamp, price_eur_per_kwh FROM stg_price"),
    ["price_eur_per_kwh"],
)
ENTRIES["y11_free_or_negative_price"] = Entry(
    lambda spark, sf: analytics.y11(marts.star(spark, sf).stg_price, free_only=True),
    with_feeds("stg_price", "SELECT timestamp, price_eur_per_kwh FROM stg_price WHERE price_eur_per_kwh <= 0"),
    ["price_eur_per_kwh"],
)
_add(
    "y12_energy_by_temp_delta",
    analytics.y12,
    """SELECT "FactKey", "IndoorTemp" - "OutdoorTemp" AS "TempDelta", "ASHP_Power" / 1000 AS energy_kwh FROM fact
WHERE "IndoorTemp" IS NOT NULL AND "OutdoorTemp" IS NOT NULL AND "ASHP_Power" IS NOT NULL""",
    ["TempDelta", "energy_kwh"],
    needs="fact",
)


def _series(group):
    return with_feeds("readings", outer_merge_sql(RAW_COLUMNS, SERIES_GROUPS[group]))


for _group in SERIES_GROUPS:
    ENTRIES[f"y13_series_{_group}"] = Entry(
        lambda spark, sf, group=_group: series(wide_raw(feeds.readings(spark, sf)), group), _series(_group)
    )
