"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage and
    fixes the rows, so that a lost executor cannot change them."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def carried(df: DataFrame, without: Iterable[str]) -> list[Column]:
    """The columns of ``df`` but those that an output replaces."""
    names = {name.lower() for name in without}
    return [df[f"`{name}`"] for name in df.columns if name.lower() not in names]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
