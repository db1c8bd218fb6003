"""Questions over the star schema.

Each function is ``f(fact, dim_time, dim_device, model=None)``. The ``a``
variants use floor bins and the calendar's own flags; the ``b`` variants use
truncating bins, recomputed 0/1 flags and the wide peak range, and take no model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import bin_end, floor_bin, trunc_bin
from ..functions.text import flag
from ..functions.time import is_peak_range, is_weekend
from ..functions.units import cost, temp_delta, w_to_kwh
from ..operators.aggregates import ratio_of_sums
from ..operators.filters import equals, free_or_negative_price, half_open, inclusive, not_null
from ..operators.joins import key_join, star_join
from ..operators.ordering import sort_by, top

# Bin widths, ranges and bands of the questions.
TEMP_BIN = 5.0
PRICE_BIN = 0.05
OUTDOOR_RANGE = (-25.0, 30.0)
INDOOR_RANGE = (15.0, 25.0)
NARROW_BAND = (19.5, 20.5)
WIDE_BAND = (20.0, 23.0)
LAST_ROWS = 10


def _power() -> Column:
    return F.col("ASHP_Power")


def _price() -> Column:
    return F.col("ElectricityPrice")


def _device(fact: DataFrame, dim_device: DataFrame, model: str | None) -> DataFrame:
    devices = equals(dim_device.select("DeviceKey", "Model", "MinPower"), "Model", model)
    return key_join(fact, devices, "DeviceKey")


def _star(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, model: str | None) -> DataFrame:
    return key_join(_device(fact, dim_device, model), dim_time, "TimeKey")


def _priced(fact: DataFrame) -> DataFrame:
    return not_null(fact, "ElectricityPrice", "ASHP_Power")


def _outdoor(fact: DataFrame) -> DataFrame:
    return not_null(half_open(fact, "OutdoorTemp", *OUTDOOR_RANGE), "ASHP_Power")


def _power_by_bin(rows: DataFrame, binned: Column) -> DataFrame:
    return sort_by(
        rows.groupBy(binned.alias("bin_start"))
        .agg(F.avg("ASHP_Power").alias("avg_power_w"), F.count("*").alias("hours"))
        .select("bin_start", bin_end(F.col("bin_start"), TEMP_BIN).alias("bin_end"), "avg_power_w", "hours"),
        "bin_start",
    )


def y1a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Average power and hours per 5 degree outdoor bin."""
    rows = _device(_outdoor(fact), dim_device, model)
    return _power_by_bin(rows, floor_bin(F.col("OutdoorTemp"), TEMP_BIN))


def y1b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    rows = _device(_outdoor(fact), dim_device, None)
    return _power_by_bin(rows, trunc_bin(F.col("OutdoorTemp"), TEMP_BIN))


def _model_extract(rows: DataFrame, weekend: Column) -> DataFrame:
    return sort_by(
        rows.select(
            "FullDate",
            "HourOfDay",
            weekend.alias("IsWeekend"),
            "OutdoorTemp",
            "IndoorTemp",
            temp_delta(F.col("IndoorTemp"), F.col("OutdoorTemp")).alias("TempDelta"),
            _power().alias("power_w"),
            w_to_kwh(_power()).alias("energy_kwh_per_hr"),
        ),
        "FullDate",
        "HourOfDay",
    )


def _heated(fact: DataFrame) -> DataFrame:
    return not_null(inclusive(fact, "IndoorTemp", *INDOOR_RANGE), "OutdoorTemp", "ASHP_Power")


def y2a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Model-ready extract of hours with a plausible indoor temperature."""
    return _model_extract(_star(_heated(fact), dim_time, dim_device, model), F.col("IsWeekend"))


def y2b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    rows = _star(_heated(fact), dim_time, dim_device, None)
    return _model_extract(rows, flag(is_weekend(F.col("DayOfWeek"))))


def _watts_per_degree(fact: DataFrame, dim_device: DataFrame, model: str | None, band) -> DataFrame:
    kept = not_null(inclusive(fact, "IndoorTemp", *band), "OutdoorTemp", "ASHP_Power")
    rows = _device(kept.filter(F.col("IndoorTemp") > F.col("OutdoorTemp")), dim_device, model)
    return rows.agg(
        ratio_of_sums(_power(), temp_delta(F.col("IndoorTemp"), F.col("OutdoorTemp"))).alias("watts_per_C"),
        F.count("*").alias("hours_used"),
    )


def y3a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Watts per degree of indoor-outdoor difference."""
    return _watts_per_degree(fact, dim_device, model, NARROW_BAND)


def y3b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    return _watts_per_degree(fact, dim_device, None, WIDE_BAND)


def _by_price_bin(rows: DataFrame, binned: Column) -> DataFrame:
    return sort_by(
        rows.groupBy(binned.alias("price_bin_eur")).agg(
            F.avg("ElectricityPrice").alias("avg_price_in_bin"),
            F.avg("ASHP_Power").alias("avg_power_w"),
            w_to_kwh(F.sum("ASHP_Power")).alias("energy_kwh"),
            F.sum(cost(_power(), _price())).alias("bucket_cost"),
            F.count("*").alias("hours"),
        ),
        "price_bin_eur",
    )


def y4a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Power, energy and cost per price bin."""
    rows = _star(_priced(fact), dim_time.select("TimeKey"), dim_device, model)
    return _by_price_bin(rows, floor_bin(_price(), PRICE_BIN))


def y4b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    rows = _star(_priced(fact), dim_time.select("TimeKey"), dim_device, None)
    return _by_price_bin(rows, trunc_bin(_price(), PRICE_BIN))


def _cost_extract(rows: DataFrame, peak: Column, weekend: Column, holiday: Column) -> DataFrame:
    return sort_by(
        rows.select(
            "FullDate",
            "HourOfDay",
            peak.alias("IsPeakHour"),
            weekend.alias("IsWeekend"),
            holiday.alias("IsHoliday"),
            _price().alias("price_eur_per_kwh"),
            _power().alias("power_w"),
            w_to_kwh(_power()).alias("energy_kwh"),
            cost(_power(), _price()).alias("cost_eur"),
        ),
        "FullDate",
        "HourOfDay",
    )


def y5a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Hourly cost extract."""
    rows = _star(_priced(fact), dim_time, dim_device, model)
    return _cost_extract(rows, F.col("IsPeakHour"), F.col("IsWeekend"), F.col("IsHoliday"))


def y5b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    rows = _star(_priced(fact), dim_time, dim_device, None)
    peak = flag(is_peak_range(F.col("HourOfDay")))
    return _cost_extract(rows, peak, flag(is_weekend(F.col("DayOfWeek"))), F.lit(0))


def _by_day_type(rows: DataFrame, day_type: Column, peak: Column) -> DataFrame:
    return sort_by(
        rows.groupBy(day_type.alias("day_type"), peak.alias("IsPeakHour")).agg(
            w_to_kwh(F.sum("ASHP_Power")).alias("energy_kwh"),
            F.sum(cost(_power(), _price())).alias("cost_eur"),
            F.avg("ElectricityPrice").alias("avg_price_eur_per_kwh"),
            F.count("*").alias("hours"),
        ),
        "day_type",
        "-IsPeakHour",
    )


def y6a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Energy and cost by day type and peak flag; a holiday outranks a weekend."""
    day_type = (
        F.when(F.col("IsHoliday"), F.lit("Holiday"))
        .when(F.col("IsWeekend"), F.lit("Weekend"))
        .otherwise(F.lit("Weekday"))
    )
    rows = _star(_priced(fact), dim_time, dim_device, model)
    return _by_day_type(rows, day_type, F.col("IsPeakHour"))


def y6b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    weekend = is_weekend(F.col("DayOfWeek"))
    day_type = F.when(weekend, F.lit("Weekend")).otherwise(F.lit("Weekday"))
    rows = _star(_priced(fact), dim_time, dim_device, None)
    return _by_day_type(rows, day_type, flag(is_peak_range(F.col("HourOfDay"))))


def _energy_by_month(rows: DataFrame, binned: Column) -> DataFrame:
    return sort_by(
        rows.groupBy("Year", "Month", binned.alias("bin_start"))
        .agg(w_to_kwh(F.sum("ASHP_Power")).alias("energy_kwh"), F.count("*").alias("hours"))
        .select(
            "Year", "Month", "bin_start", bin_end(F.col("bin_start"), TEMP_BIN).alias("bin_end"),
            "energy_kwh", "hours",
        ),
        "Year",
        "Month",
        "bin_start",
    )


def y7a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Energy per month and outdoor bin."""
    rows = _star(_outdoor(fact), dim_time, dim_device, model)
    return _energy_by_month(rows, floor_bin(F.col("OutdoorTemp"), TEMP_BIN))


def y7b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    rows = _star(_outdoor(fact), dim_time, dim_device, None)
    return _energy_by_month(rows, trunc_bin(F.col("OutdoorTemp"), TEMP_BIN))


def y8a(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame, *, model: str | None = None) -> DataFrame:
    """Hours per day below the device's rated minimum."""
    rows = _star(not_null(fact, "ASHP_Power"), dim_time, dim_device, model)
    idle = not_null(rows, "MinPower").filter(_power() < F.col("MinPower"))
    return sort_by(
        idle.groupBy("Year", "Month", "Day").agg(F.count("*").alias("hours_below_min")),
        "Year",
        "Month",
        "Day",
    )


def y8b(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    return y8a(fact, dim_time, dim_device)


def _last_rows(
    view: DataFrame, dim_time: DataFrame, dim_device: DataFrame, dim_location: DataFrame, price: str, power: str, limit: int
) -> DataFrame:
    joined = star_join(
        view.select("FactKey", "TimeKey", "DeviceKey", "LocationKey", price, "WC_Temp", power),
        {
            "TimeKey": dim_time.select("TimeKey", "IsHoliday", "Month", "Day", "HourOfDay", "IsWeekend"),
            "DeviceKey": dim_device.select("DeviceKey", "Brand", "Model"),
            "LocationKey": dim_location.select("LocationKey", "DeviceLocation", "PricingRegion"),
        },
    )
    return top(joined, limit, "-TimeKey", "-FactKey").select(
        "FactKey", price, "WC_Temp", power, "IsHoliday", "Month", "Day", "HourOfDay", "IsWeekend",
        "Brand", "Model", "DeviceLocation", "PricingRegion",
    )


def y9(
    full: DataFrame, dim_time: DataFrame, dim_device: DataFrame, dim_location: DataFrame, *, limit: int = LAST_ROWS
) -> DataFrame:
    """Last rows of the full view with their dimensions."""
    return _last_rows(full, dim_time, dim_device, dim_location, "ElectricityPrice", "ASHP_Power", limit)


def y10(
    limited: DataFrame, dim_time: DataFrame, dim_device: DataFrame, dim_location: DataFrame, *, limit: int = LAST_ROWS
) -> DataFrame:
    """Last rows of the limited view with their dimensions."""
    return _last_rows(
        limited, dim_time, dim_device, dim_location, "ElectricityPrice_Range", "ASHP_Power_Range", limit
    )


def y11(stg_price: DataFrame, *, free_only: bool = False) -> DataFrame:
    """Price series; ``free_only`` drills down to zero and negative prices."""
    rows = free_or_negative_price(stg_price, "price_eur_per_kwh") if free_only else stg_price
    return sort_by(rows.select("timestamp", "price_eur_per_kwh"), "timestamp")


def y12(fact: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Energy against temperature difference, one pair per hour."""
    rows = not_null(fact, "IndoorTemp", "OutdoorTemp", "ASHP_Power")
    return rows.select(
        "FactKey",
        temp_delta(F.col("IndoorTemp"), F.col("OutdoorTemp")).alias("TempDelta"),
        w_to_kwh(_power()).alias("energy_kwh"),
    )
