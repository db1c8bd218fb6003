"""Unit conversions and hourly energy arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors.
MMHG_PER_HPA = 0.750061683
KMH_PER_MS = 3.6
KILO = 1000.0
RADIATION_PER_UV = 25.0


def hpa_to_mmhg(x: Column) -> Column:
    return x * F.lit(MMHG_PER_HPA)


def kmh_to_ms(x: Column) -> Column:
    return x / F.lit(KMH_PER_MS)


def mwh_to_kwh_price(x: Column) -> Column:
    return x / F.lit(KILO)


def w_to_kwh(x: Column) -> Column:
    """Energy of one hourly row."""
    return x / F.lit(KILO)


def cost(power_w: Column, price_per_kwh: Column) -> Column:
    return w_to_kwh(power_w) * price_per_kwh


def temp_delta(indoor: Column, outdoor: Column) -> Column:
    return indoor - outdoor


def uv_from_radiation(x: Column) -> Column:
    """UV estimate, rounded half to even."""
    return F.bround(x / F.lit(RADIATION_PER_UV))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0.0))
