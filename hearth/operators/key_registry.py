"""Surrogate keys that stay: an append-only registry from natural key to number.

A registry is a folder of parts, each a Parquet folder whose name says which numbers it
holds. A part becomes visible in one step and is never changed. When there are many, one
part that holds them all takes their place; parts that another one contains are not read.
One writer at a time per registry.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import delete, names, publish
from .filters import nothing
from .keys import surrogate_key

# Parts beyond which a registry is written anew as one.
MANY_PARTS = 32


def _parts(spark: SparkSession, registry: str) -> dict[str, tuple[int, int]]:
    """Parts that no other one contains, with their first and last number."""
    found = {name: tuple(map(int, name.split("-"))) for name in names(spark, f"{registry}/parts")}

    def contained(name: str) -> bool:
        first, last = found[name]
        return any(other != name and found[other][0] <= first and last <= found[other][1] for other in found)

    return {name: span for name, span in found.items() if not contained(name)}


def _schema(df: DataFrame, natural: Sequence[str], name: str) -> T.StructType:
    return T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in natural], T.StructField(name, T.LongType())])


def read_registry(spark: SparkSession, registry: str, schema: T.StructType) -> DataFrame:
    """Natural keys and their numbers; empty if there is no registry yet."""
    parts = [f"{registry}/parts/{name}" for name in _parts(spark, registry)]
    return spark.read.schema(schema).parquet(*parts) if parts else nothing(spark, schema)


def _append(rows: DataFrame, registry: str, first: int, last: int) -> None:
    incoming = f"{registry}/incoming-{uuid.uuid4().hex}"
    rows.write.parquet(incoming)
    publish(rows.sparkSession, incoming, f"{registry}/parts/{first:020d}-{last:020d}")
    delete(rows.sparkSession, incoming)


def _compact(spark: SparkSession, registry: str, schema: T.StructType) -> None:
    """All parts as one; those it contains go, at the latest by the next writer."""
    parts = _parts(spark, registry)
    if len(parts) > MANY_PARTS:
        rows = read_registry(spark, registry, schema)
        _append(rows, registry, min(a for a, _ in parts.values()), max(z for _, z in parts.values()))
        parts = _parts(spark, registry)
    for name in names(spark, f"{registry}/parts"):
        if name not in parts:
            delete(spark, f"{registry}/parts/{name}")


def _same(left: DataFrame, right: DataFrame, natural: Sequence[str]):
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in natural])


def stable_key(df: DataFrame, natural: Sequence[str], name: str, registry: str) -> DataFrame:
    """``df`` with the number of its ``natural`` key (NULL is a value) in the column ``name``.

    Numbers are dense from 1. Natural keys without one are numbered in their order, after
    all that were given before; earlier numbers never change. Rows of one natural key share
    their number. A run that dies has either added all of its new keys or none.
    """
    spark, registry = df.sparkSession, registry.rstrip("/")
    schema = _schema(df, natural, name)
    known = read_registry(spark, registry, schema)
    asked = df.select(*natural).distinct()
    fresh = asked.join(known, _same(asked, known, natural), "left_anti")
    last = max((z for _, z in _parts(spark, registry).values()), default=0)
    numbered = surrogate_key(fresh, list(natural), name).select(*natural, (F.col(name) + F.lit(last)).cast("bigint").alias(name))
    staged = f"{registry}/numbered-{uuid.uuid4().hex}"
    try:
        numbered.write.parquet(staged)
        new = spark.read.schema(schema).parquet(staged)
        count = new.count()
        if count:
            _append(new, registry, last + 1, last + count)
        _compact(spark, registry, schema)
    finally:
        delete(spark, staged)
    known = read_registry(spark, registry, schema)
    numbers = known.select(*[F.col(c).alias(f"_key_{c}") for c in natural], name)
    match = reduce(and_, [df[c].eqNullSafe(numbers[f"_key_{c}"]) for c in natural])
    return df.join(numbers, match).select(name, *df.columns)
