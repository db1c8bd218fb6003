"""Rows that come too late for a stream, kept for a replay.

Stateful operators drop rows behind the watermark without a trace. Here a first query
admits each micro-batch: rows whose hour (or time) is already closed go to a late table,
all others to an accepted one, and the stateful queries read the accepted rows. They
take whole batches, so their watermark is never ahead of the one that admitted a row:
what was accepted is not dropped. :func:`hearth.plans.ingest.replay_late` then brings
the late rows in.

Below one root: ``accepted/batch-N`` and ``late/batch-N`` (Parquet), ``marks`` (empty
files whose names say the greatest time up to a batch), ``replayed`` (one empty file for
each late batch that has been brought in).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import hour_start
from ..operators.filters import nothing
from ..paths import delete, make_folder, names, publish, touch

# Marks of batches before the last that are kept, for a batch that is run again.
KEPT_MARKS = 16


def _batch(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def _greatest_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Greatest event time, in microseconds, of all batches before this one."""
    found = [mark.split("_") for mark in names(spark, f"{root}/marks")]
    known = [int(micros) for name, micros in found if name < _batch(batch_id)]
    return max(known, default=None)


def _mark(spark: SparkSession, root: str, batch_id: int, micros: int | None) -> None:
    if micros is None:
        return
    touch(spark, f"{root}/marks/{_batch(batch_id)}_{micros}")
    for name in names(spark, f"{root}/marks")[: -KEPT_MARKS - 1]:
        delete(spark, f"{root}/marks/{name}")


def closed(ts: str, watermark: Column, by: str) -> Column:
    """Whether a stateful operator drops a row: by the hour it falls in, or by its own time."""
    if by not in ("hour", "row"):
        raise ValueError("by must be 'hour' or 'row'")
    time = hour_start(F.col(ts)) + F.expr("interval 1 hour") if by == "hour" else F.col(ts)
    return F.coalesce(time <= watermark, F.lit(False))


def admit_sink(root: str, ts: str, delay: str, *, by: str = "hour") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that parts a batch into accepted and late rows.

    The watermark is ``delay`` before the greatest ``ts`` of all earlier batches, as
    Spark's own. The batch is read and written once; a batch that is run again changes
    nothing that was published. ``by`` names what closes: the hour of a row for hourly
    models, the row's time for :func:`hearth.streaming.dedup_stream`. Rows without a time
    are accepted. Publishing needs a file system that renames a folder in one step.
    """
    root = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _greatest_before(spark, root, batch_id)
        late = F.lit(False)
        if before is not None:
            late = closed(ts, F.timestamp_micros(F.lit(before)) - F.expr(f"interval {delay}"), by)
        seen, staging = Observation(), f"{root}/incoming/{_batch(batch_id)}"
        observed = batch.withColumn("is_late", late).observe(seen, F.max(F.unix_micros(ts)).alias("greatest"))
        observed.write.mode("overwrite").partitionBy("is_late").parquet(staging)
        for flag, name in (("true", "late"), ("false", "accepted")):
            publish(spark, f"{staging}/is_late={flag}", f"{root}/{name}/{_batch(batch_id)}")
        greatest = [one for one in (before, seen.get["greatest"]) if one is not None]
        _mark(spark, root, batch_id, max(greatest, default=None))
        delete(spark, staging)

    return write


def stream_accepted(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Accepted rows as a stream of whole batches; give stateful operators the delay of the admission."""
    accepted = f"{root.rstrip('/')}/accepted"
    make_folder(spark, accepted)
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(accepted)


def pending_batches(spark: SparkSession, root: str) -> list[str]:
    """Late batches that no replay has brought in yet."""
    done = set(names(spark, f"{root.rstrip('/')}/replayed"))
    return [name for name in names(spark, f"{root.rstrip('/')}/late") if name not in done]


def late_rows(spark: SparkSession, root: str, schema: T.StructType, ts: str, batches: list[str] | None = None) -> DataFrame:
    """Late rows, of all batches or of those named, with the hour they belong to."""
    late = f"{root.rstrip('/')}/late"
    wanted = names(spark, late) if batches is None else batches
    rows = nothing(spark, schema)
    if wanted:
        rows = spark.read.schema(schema).parquet(*[f"{late}/{name}" for name in wanted])
    return rows.withColumn("late_hour", hour_start(F.col(ts)))


def mark_replayed(spark: SparkSession, root: str, batches: list[str]) -> None:
    for name in batches:
        touch(spark, f"{root.rstrip('/')}/replayed/{name}")
