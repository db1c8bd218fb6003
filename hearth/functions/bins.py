"""Numeric bins. Everything is double so both bin styles share a type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_bin(x: Column, width: float) -> Column:
    """Lower edge of the bin, rounding towards minus infinity."""
    w = F.lit(float(width))
    return w * F.floor(x / w)


def trunc_bin(x: Column, width: float) -> Column:
    """Bin edge rounding towards zero, so both sides of zero share bin 0."""
    w = F.lit(float(width))
    return w * (x / w).cast("bigint")


def bin_end(start: Column, width: float) -> Column:
    return start + F.lit(float(width))


def half_floor(x: Column) -> Column:
    """Largest multiple of one half that is not above ``x``; a zero keeps its sign."""
    return F.when(x == F.lit(0.0), x).otherwise(F.floor(x * F.lit(2.0)) / F.lit(2.0))
