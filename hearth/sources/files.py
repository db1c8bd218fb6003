"""Flat files and stored tables, always with an explicit schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.filters import nothing
from ..paths import path_and_fs
from ..schemas import BRONZE_PRICE, HOLIDAYS, READINGS_CSV


def _by_name(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Header CSV with its columns matched by name, whatever their order in the file.

    Further columns of the file are left out, a missing one is an error, and so
    is a folder whose files have different headers. ``multi_line`` allows line
    breaks inside quotes, but a file is then read by one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    found = reader.csv(path).columns
    missing = [name for name in schema.names if name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(found)}")
    in_file = T.StructType([schema[name] if name in schema.names else T.StructField(name, T.StringType()) for name in found])
    return reader.schema(in_file).option("enforceSchema", False).csv(path).select(*schema.names)


def read_scd_csv(spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = True) -> DataFrame:
    """Header CSV of a dimension with validity dates."""
    return _by_name(spark, path, schema, multi_line)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Holiday list ``timestamp,name``."""
    return read_scd_csv(spark, path, HOLIDAYS)


def read_readings_csv(
    spark: SparkSession, path: str, schema: T.StructType = READINGS_CSV, *, multi_line: bool = False
) -> DataFrame:
    """Exploratory export; times stay text, as in the file."""
    return _by_name(spark, path, schema, multi_line)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, *, recursive: bool = False
) -> DataFrame:
    """Parquet under ``path``, or an empty relation of the same schema."""
    place, fs = path_and_fs(spark, path)
    if not fs.globStatus(place):
        return nothing(spark, schema)
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing(spark, schema)


def read_price_table(spark: SparkSession, path: str, *, recursive: bool = False) -> DataFrame:
    """Five-column view of the day-partitioned price table.

    The partition column is left out, as in the view; filter on ``ts_day`` with
    :func:`hearth.sinks.read_days` when only some days are needed.
    """
    return read_or_empty(spark, path, BRONZE_PRICE, recursive=recursive).select(*BRONZE_PRICE.names)
