"""Safe parsing of sensor text and JSON attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only texts read as numbers.
NUMERIC_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def safe_number(text: Column) -> Column:
    """Double, or NULL for anything that is not a finite decimal number."""
    number = text.try_cast("double")
    return F.when(text.rlike(NUMERIC_TEXT) & (F.abs(number) < F.lit(float("inf"))), number)


def json_number(attributes: Column, key: str) -> Column:
    """Number under ``key`` of a JSON text; NULL when absent or not numeric."""
    return safe_number(F.trim(F.get_json_object(attributes, f"$.{key}")))


def first_present(*cols: Column) -> Column:
    """First value that is not NULL; zero counts as a value."""
    return F.coalesce(*cols)


def to_json_text(struct: Column) -> Column:
    """JSON text that keeps keys whose value is NULL."""
    return F.to_json(struct, {"ignoreNullFields": "false"})
