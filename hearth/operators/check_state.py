"""Check results kept by day, so that a run looks at the days that changed only.

Below one state folder, for one table that carries its day in ``ts_day``: ``rows`` has the
failing rows of each rule and day, which are summed; ``keys`` the values of each unique
column by day, and ``repeated`` those values that occur more than once over all days;
``parents`` a fingerprint of each parent's keys. One writer at a time per folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import delete, names, publish, touch
from ..sinks import DAY, on_days, read_days, replace_days
from ..sources.files import read_or_empty
from .joins import orphans
from .quality import Check

_ROWS = "column string, check string, failing bigint, at timestamp"
_KEYS = "column string, value string, n bigint, at timestamp"
_REPEATED = "column string, value string"


def _schema(spark: SparkSession, text: str):
    return spark.createDataFrame([], text).schema


def _labels(check: Check):
    return F.lit(check.column).alias("column"), F.lit(check.label).alias("check")


def _row_results(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    """Failing rows by day of all row-level rules, in one aggregation."""
    if not checks:
        return []
    counted = df.groupBy(DAY).agg(*[F.count_if(c.violated()).alias(f"c{i}") for i, c in enumerate(checks)])
    lines = [F.struct(*_labels(c), F.col(f"c{i}").alias("failing")) for i, c in enumerate(checks)]
    return [counted.select(DAY, F.inline(F.array(*lines)))]


def _orphan_results(df: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    """Rows without a parent by day; repeated keys of a day collapse before the join."""
    keyed = df.groupBy(DAY, check.column).agg(F.count(F.lit(1)).alias("n"))
    missing = orphans(keyed, check.column, parent, check.parent_key).groupBy(DAY).agg(F.sum("n").alias("failing"))
    return missing.select(DAY, *_labels(check), "failing")


def _fingerprint(parent: DataFrame, key: str) -> str:
    row = parent.select(key).distinct().agg(F.count(F.lit(1)), F.sum(F.xxhash64(key).cast("decimal(38,0)"))).first()
    return f"{row[0]}_{row[1] or 0}"


def _stored(spark: SparkSession, state: str, part: str, text: str) -> DataFrame:
    return read_days(spark, f"{state}/{part}", _schema(spark, text))


def _put(df: DataFrame, state: str, part: str, days: Sequence) -> None:
    at = F.col(DAY).cast("timestamp").alias("at")
    replace_days(df.select(*[c for c in df.columns if c != DAY], at), f"{state}/{part}", "at", days)


def _update_repeated(spark: SparkSession, state: str, before: DataFrame, days: Sequence) -> None:
    """Values of the days that changed, then or now, are counted over all days; others stand."""
    now = _stored(spark, state, "keys", _KEYS)
    touched = before.select("column", "value").unionByName(now.filter(on_days(days)).select("column", "value")).distinct()
    totals = now.join(touched, ["column", "value"], "left_semi").groupBy("column", "value").agg(F.sum("n").alias("n"))
    old = read_or_empty(spark, _current(spark, f"{state}/repeated"), _schema(spark, _REPEATED))
    kept = old.join(touched, ["column", "value"], "left_anti")
    _next(kept.unionByName(totals.filter("n > 1").select("column", "value")), f"{state}/repeated")


def _current(spark: SparkSession, folder: str) -> str:
    versions = names(spark, folder)
    return f"{folder}/{versions[-1] if versions else 'none'}"


def _next(df: DataFrame, folder: str) -> None:
    """A new version of a small table; it is seen as a whole, and the one before goes."""
    spark, versions = df.sparkSession, names(df.sparkSession, folder)
    number = int(versions[-1]) + 1 if versions else 0
    staged = f"{folder}_next"
    df.write.mode("overwrite").parquet(staged)
    publish(spark, staged, f"{folder}/{number:012d}")
    for name in versions:
        delete(spark, f"{folder}/{name}")


def update_checks(
    df: DataFrame, checks: Sequence[Check], state: str, days: Sequence, parents: Mapping[str, DataFrame] | None = None
) -> None:
    """Bring the state of a day-partitioned table up to date after ``days`` changed.

    Only those days of ``df`` are read, named as literals, unless the keys of a parent
    changed: its relationships are then counted anew for all days. A day that has no
    rows any more is named too. A run that dies is repeated with the same days.
    """
    spark, state, days = df.sparkSession, state.rstrip("/"), list(days)
    touched, found = df.filter(on_days(days)), []
    found += _row_results(touched, [c for c in checks if c.kind in ("not_null", "expression")])
    stale: list[Check] = []
    known = dict(name.rsplit("=", 1) for name in names(spark, f"{state}/parents"))
    marks = {}
    for check in (c for c in checks if c.kind == "relationships"):
        parent = parents[check.parent]
        marks[check.column] = _fingerprint(parent, check.parent_key)
        if known.get(check.column, marks[check.column]) != marks[check.column]:
            stale.append(check)
        found.append(_orphan_results(touched, check, parent))
    if found:
        _put(reduce(DataFrame.unionByName, found), state, "rows", days)
    if stale:
        _renew_orphans(df, stale, state, parents)
    unique = [c for c in checks if c.kind == "unique"]
    if unique:
        before = read_days(spark, f"{state}/keys", _schema(spark, _KEYS)).filter(on_days(days)).select("column", "value").distinct()
        path = f"{state}/keys_before"
        if not names(spark, path):  # of a run that died: what it had found before it changed the keys
            before.write.mode("overwrite").parquet(path)
        keys = [
            touched.filter(F.col(c.column).isNotNull()).groupBy(DAY, F.col(c.column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).select(DAY, F.lit(c.column).alias("column"), "value", "n")
            for c in unique
        ]
        _put(reduce(DataFrame.unionByName, keys), state, "keys", days)
        _update_repeated(spark, state, spark.read.schema("column string, value string").parquet(path), days)
        delete(spark, path)
    _mark(spark, state, marks)


def _renew_orphans(df: DataFrame, checks: Sequence[Check], state: str, parents: Mapping[str, DataFrame]) -> None:
    spark = df.sparkSession
    stored = _stored(spark, state, "rows", _ROWS)
    of_checks = reduce(lambda a, b: a | b, [(F.col("column") == c.column) & (F.col("check") == c.label) for c in checks])
    new = reduce(DataFrame.unionByName, [_orphan_results(df, c, parents[c.parent]) for c in checks])
    kept = stored.filter(~of_checks).select(DAY, "column", "check", "failing")
    days = [r[DAY] for r in kept.select(DAY).unionByName(new.select(DAY)).unionByName(stored.select(DAY)).distinct().collect()]
    _put(kept.unionByName(new), state, "rows", days)


def _mark(spark: SparkSession, state: str, marks: Mapping[str, str]) -> None:
    for column, mark in marks.items():
        for name in names(spark, f"{state}/parents"):
            if name.rsplit("=", 1)[0] == column and name != f"{column}={mark}":
                delete(spark, f"{state}/parents/{name}")
        touch(spark, f"{state}/parents/{column}={mark}")


def read_checks(spark: SparkSession, table: str, checks: Sequence[Check], state: str) -> DataFrame:
    """``(table, column, check, failing)`` for every check, as :func:`hearth.operators.quality.run_suite` gives it."""
    state = state.rstrip("/")
    rows = _stored(spark, state, "rows", _ROWS).groupBy("column", "check").agg(F.sum("failing").alias("failing"))
    repeated = read_or_empty(spark, _current(spark, f"{state}/repeated"), _schema(spark, _REPEATED))
    values = repeated.groupBy("column").agg(F.count(F.lit(1)).alias("failing")).select("column", F.lit("unique").alias("check"), "failing")
    wanted = spark.range(1).select(F.inline(F.array(*[F.struct(*_labels(c)) for c in checks])))
    told = wanted.join(rows.unionByName(values), ["column", "check"], "left")
    return told.select(F.lit(table).alias("table"), "column", "check", F.coalesce("failing", F.lit(0)).cast("bigint").alias("failing"))
