"""Writes to Parquet tables: append, replace an interval, overwrite.

A table is a folder. Tables that take interval writes are partitioned by day in
``ts_day``; replacing an interval rewrites only the days it touches. The new
content of those days is staged in full beside the table, and a note next to it
says where, before the table changes. The change itself is one dynamic partition
overwrite; if the job dies in the middle of it, the next write finds the note and
completes the change first. Staged rows go with the change they belong to, or at
once if a write fails before its note stands. One writer at a time per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.aggregates import latest_per_key
from .operators.filters import day_range, in_window, nothing
from .operators.sets import replace_where
from .sources.files import read_or_empty

DAY = "ts_day"


def _path_and_fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _drop_day(spark: SparkSession, table: str, day) -> None:
    folder, fs = _path_and_fs(spark, f"{table.rstrip('/')}/{DAY}={day.isoformat()}")
    fs.delete(folder, True)


def _balanced_by_day(df: DataFrame) -> DataFrame:
    """Day-aligned files; adaptive execution splits a hot day over several tasks."""
    return df.hint("rebalance", F.col(DAY))


def with_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(F.col(ts)))


def read_days(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Day-partitioned table with its partition column; empty when absent."""
    if DAY not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return read_or_empty(spark, table, schema)


def append(df: DataFrame, table: str, *, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Drop and recreate; ``df`` must not read from ``table`` itself."""
    df.write.mode("overwrite").parquet(table)


def create_if_absent(df: DataFrame, table: str) -> None:
    df.write.mode("ignore").parquet(table)


def write_day_partitioned(df: DataFrame, table: str, ts: str, *, mode: str = "append") -> None:
    _balanced_by_day(with_day(df, ts)).write.mode(mode).partitionBy(DAY).parquet(table)


def write_clustered(
    df: DataFrame, table: str, keys: Sequence[str], *, mode: str = "overwrite", bloom: Mapping[str, int] | None = None
) -> None:
    """Stored in key order, so Parquet min/max statistics can skip row groups.

    Range partitioning on the whole key splits a dominant leading value, and the
    hash of the row splits rows that share their key. ``bloom`` names columns that also
    get a bloom filter, with the distinct values to expect in a row group: it skips those
    whose range holds a value that is asked for while none of their rows does.
    """
    writer = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys).write.mode(mode)
    for column, distinct in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(table)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def materialize(df: DataFrame, kind: str, name: str, root: str | None = None) -> DataFrame:
    """A ``table`` is written below ``root`` and read back; a ``view`` stays lazy."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError("kind must be 'table' or 'view'")
    path = f"{root.rstrip('/')}/{name}"
    overwrite(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder, fs = _path_and_fs(spark, path)
    fs.delete(folder, True)


def _new_staging(table: str) -> str:
    return f"{table.rstrip('/')}_staging/{uuid.uuid4().hex}"


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _note(table: str) -> str:
    return f"{table.rstrip('/')}_pending"


def _noted(spark: SparkSession, table: str) -> bool:
    done, fs = _path_and_fs(spark, f"{_note(table)}/_SUCCESS")
    return fs.exists(done)


def _swap(content: DataFrame, table: str, emptied: Sequence) -> None:
    """Make ``content`` the whole of its days and drop the emptied ones. Repeatable."""
    (
        _balanced_by_day(content)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(table)
    )
    for day in emptied:
        _drop_day(content.sparkSession, table, day)


def _release_staging(spark: SparkSession, table: str, staging: str) -> None:
    """Delete one write's staged rows, and the folder of all of them once it is empty."""
    _delete(spark, staging)
    parent, fs = _path_and_fs(spark, f"{table.rstrip('/')}_staging")
    if fs.exists(parent) and not fs.listStatus(parent):
        fs.delete(parent, True)


def _finish_pending(spark: SparkSession, table: str) -> None:
    """Complete a change that an earlier job noted but did not finish."""
    if _noted(spark, table):
        pending = spark.read.schema("content string, emptied array<date>").json(_note(table)).first()
        _swap(spark.read.parquet(pending["content"]), table, pending["emptied"])
        _delete(spark, _note(table))
        _release_staging(spark, table, pending["content"].rsplit("/", 1)[0])
    _delete(spark, _note(table))


def days_of(df: DataFrame) -> list:
    """Distinct days; at most one value per calendar day of a batch or interval."""
    return [row[DAY] for row in df.select(DAY).distinct().collect()]


def on_days(days: Sequence) -> Column:
    """Condition with the days as literals, so that Spark prunes the other day folders."""
    return F.col(DAY).isin(list(days)) if days else F.lit(False)


def _put_days(current: DataFrame, content: DataFrame, path: str, table: str, touched: Column) -> None:
    """Make the staged ``content`` the whole of the touched days of ``table``."""
    spark = content.sparkSession
    before = current.filter(touched).select(DAY).distinct()
    emptied = days_of(before.join(content.select(DAY).distinct(), DAY, "left_anti"))
    days = F.array(*[F.lit(day) for day in emptied]).cast("array<date>")
    note = spark.range(1, numPartitions=1).select(F.lit(path).alias("content"), days.alias("emptied"))
    note.write.mode("overwrite").json(_note(table))
    _swap(content, table, emptied)
    _delete(spark, _note(table))


@contextmanager
def staged_batch(df: DataFrame, table: str, **measures: Column) -> Iterator[tuple[DataFrame, dict]]:
    """``df`` written once beside ``table``, with aggregates of its rows taken by that same write.

    Gives the written rows and the values of ``measures`` by name. What reads ``df`` is
    thus read once, however often its rows are needed; they go at the end of the block.
    """
    spark, staging = df.sparkSession, _new_staging(table)
    observation = Observation()
    try:
        observed = df.observe(observation, *[value.alias(name) for name, value in measures.items()]) if measures else df
        rows = _staged(observed, f"{staging}/landed")
        yield rows, observation.get if measures else {}
    finally:
        _release_staging(spark, table, staging)


def replace_interval(
    df: DataFrame, table: str, ts: str, start, end, *, allow_empty: bool = False, is_staged: bool = False
) -> bool:
    """Delete ``[start, end)`` from ``table``, then append ``df``. Safe to rerun.

    An empty batch leaves the table alone unless ``allow_empty`` is set. Rows of
    ``df`` outside the interval are appended without deleting anything. Say
    ``is_staged`` if ``df`` reads a written batch; it is then not written again.
    Returns whether the table was changed.
    """
    spark, staging = df.sparkSession, _new_staging(table)
    try:
        new = with_day(df, ts) if is_staged else _staged(with_day(df, ts), f"{staging}/new-rows")
        summary = new.agg(
            F.count("*").alias("rows"),
            F.count_if(F.col(ts).isNull()).alias("untimed"),
            F.count_if(~day_range(DAY, start, end)).alias("elsewhere"),
        ).first()
        if summary["untimed"]:
            raise ValueError(f"{summary['untimed']} rows have no {ts} and fit no interval")
        if not summary["rows"] and not allow_empty:
            return False
        _finish_pending(spark, table)
        current = read_days(spark, table, new.schema)
        touched = day_range(DAY, start, end)
        affected = current.filter(touched)
        if summary["elsewhere"]:
            other_days = days_of(new.filter(~touched))
            affected = affected.unionByName(current.filter(~touched).filter(on_days(other_days)))
        path = f"{staging}/new-days"
        content = _staged(replace_where(affected, new, in_window(ts, start, end)), path)
        _put_days(current, content, path, table, touched)
        return True
    finally:
        if not _noted(spark, table):  # a noted change still needs its rows
            _release_staging(spark, table, staging)


def replace_days(df: DataFrame, table: str, ts: str, days: Sequence) -> None:
    """Make ``df`` the whole of ``days``; days without a row disappear. Safe to rerun."""
    spark, staging = df.sparkSession, _new_staging(table)
    try:
        path = f"{staging}/new-days"
        content = _staged(with_day(df, ts), path)
        _finish_pending(spark, table)
        _put_days(read_days(spark, table, content.schema), content, path, table, on_days(days))
    finally:
        if not _noted(spark, table):
            _release_staging(spark, table, staging)


def newest(df: DataFrame, keys: Sequence[str], version: str = "ingestion_ts") -> DataFrame:
    """One row per key: the greatest ``version``, then the greatest of the other
    columns in their order. Without such a column the other columns alone decide."""
    others = [c for c in df.columns if c not in keys and c != version]
    if version in df.columns:
        return latest_per_key(df, list(keys), version, [version, *others])
    return latest_per_key(df, list(keys), others[0], others) if others else df.dropDuplicates(list(keys))


def replace_range_backfill(df: DataFrame, table: str, ts: str, start, end, keys: Sequence[str]) -> bool:
    """Replace a long range; ``end`` is exclusive, so newer rows survive.

    Chunked loads overlap on their boundary days, so of several versions of one
    ``keys`` value within the batch the newest counts.
    """
    return replace_interval(newest(df, keys), table, ts, start, end)


def clear_range(spark: SparkSession, table: str, schema: T.StructType, ts: str, start, end) -> None:
    """Unconditional delete of ``[start, end)``; emptied days disappear."""
    replace_interval(nothing(spark, schema), table, ts, start, end, allow_empty=True)


def upsert_rows(df: DataFrame, table: str, ts: str, keys: Sequence[str]) -> None:
    """Insert rows, replacing stored ones with the same ``keys``.

    Of several versions of a key within the batch the newest counts; NULL is a value
    of a key. Reads and rewrites only the days the batch touches; ``keys`` must
    determine ``ts``.
    """
    spark, staging = df.sparkSession, _new_staging(table)
    try:
        new = _staged(newest(with_day(df, ts), keys), f"{staging}/new-rows")
        days = days_of(new)
        if not days:
            return
        _finish_pending(spark, table)
        current = read_days(spark, table, new.schema).filter(on_days(days))
        if current.isEmpty():  # the staged rows are the whole of their days
            _put_days(current, new, f"{staging}/new-rows", table, F.lit(False))
            return
        given = new.select(*[F.col(key).alias(f"_given_{i}") for i, key in enumerate(keys)])
        same = [current[key].eqNullSafe(given[f"_given_{i}"]) for i, key in enumerate(keys)]
        kept = current.join(given, same, "left_anti")
        path = f"{staging}/new-days"
        content = _staged(kept.select(*new.columns).unionByName(new), path)
        # every touched day has at least the new rows, so none can end up empty
        _put_days(current, content, path, table, F.lit(False))
    finally:
        if not _noted(spark, table):
            _release_staging(spark, table, staging)
