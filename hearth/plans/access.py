"""Full and pseudonymised projections of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import half_range_label, mask, width_range_label

# Fixed value: width of the published power ranges in watts.
POWER_RANGE_W = 100.0


def full_access(fact: DataFrame) -> DataFrame:
    return fact.select("*")


def limited_access(fact: DataFrame) -> DataFrame:
    """Price and heat pump power as ranges, one temperature masked."""
    replaced = {
        "ElectricityPrice": half_range_label(F.col("ElectricityPrice")).alias("ElectricityPrice_Range"),
        "ASHP_Power": width_range_label(F.col("ASHP_Power"), POWER_RANGE_W).alias("ASHP_Power_Range"),
        "WC_Temp": mask().alias("WC_Temp"),
    }
    return fact.select(*[replaced.get(name, F.col(name)) for name in fact.columns])
