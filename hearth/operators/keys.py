"""Dense surrogate keys 1..N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sizing import SMALL_ROWS, fits

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low bits
# Equal rows that one task numbers and gives out again.
COPIES = 100_000


def _with_offsets(sizes: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket. One row per bucket, so one task is enough."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))


def ordered_key(df: DataFrame, order_cols: list[str], name: str) -> DataFrame:
    """``row_number`` over the whole frame in one window; only for small frames."""
    number = F.row_number().over(Window.orderBy(*order_cols)).cast("bigint")
    return df.select(number.alias(name), *df.columns)


def calendar_row_number(df: DataFrame, ts: str, name: str) -> DataFrame:
    """Dense key in time order, numbered month by month.

    ``ts`` must be unique. A month of hours has at most 745 rows, so no task
    sees more than that, and the month totals are a handful of rows per year.
    """
    monthly = df.withColumn("_month", F.date_trunc("month", F.col(ts)))
    # one row per calendar month: bounded by the calendar, not by the data
    offsets = F.broadcast(_with_offsets(monthly.groupBy("_month").count(), "_month"))
    position = F.row_number().over(Window.partitionBy("_month").orderBy(ts))
    return (
        monthly.withColumn("_position", position)
        .join(offsets, "_month")
        .select((F.col("_before") + F.col("_position")).alias(name), *df.columns)
    )


def _position() -> Column:
    return F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def _slotted(df: DataFrame, order: Sequence[str], path: str, partitions: int | None) -> DataFrame:
    """``df`` in range partitions of ``order``, written once with each row's partition and place in it."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_slot", _ROW_BITS))


def _slotted_copies(df: DataFrame, order: Sequence[str], path: str, partitions: int | None) -> DataFrame:
    """As :func:`_slotted`, equal rows as one with their number ``_copies``; more than ``COPIES``
    of a row are several rows, which partitions can share."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_all"))
    chunked = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_all") - 1, F.lit(COPIES).cast("bigint"))))
    rows = chunked.withColumn("_copies", F.least(F.lit(COPIES).cast("bigint"), F.col("_all") - F.col("_chunk"))).drop("_all")
    others = [c for c in df.columns if c not in order]
    return _slotted(rows, [*order, *others, "_chunk"], path, partitions)


def _expanded(rows: DataFrame, first: Column, name: str, columns: Sequence[str]) -> DataFrame:
    """Every row as often as it occurs, numbered from ``first``."""
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))
    return rows.select(first.alias("_first"), "*", copies.alias("_copy")).select((F.col("_first") + F.col("_copy")).alias(name), *columns)


def global_row_number(
    df: DataFrame,
    order_cols: list[str],
    name: str,
    *,
    partitions: int | None = None,
    stage_path: str | None = None,
    unique: bool = True,
) -> DataFrame:
    """Dense key over any number of rows, without a single-task window.

    The frame is range-partitioned and sorted, then written once with each
    row's partition and position. Reading the written table back makes the
    numbers final: a lost executor cannot renumber rows. The key of a row is its
    position plus the rows of all earlier partitions. A hot leading value is
    split by the columns after it. If ``order_cols`` do not identify a row, say
    ``unique=False``: the other columns then decide, equal rows are counted before
    the shuffle, and their numbers are dealt out in parts.
    """
    path, order = stage_path or scratch_path(df.sparkSession, "row-number"), list(order_cols)
    if unique:
        staged = _slotted(df, order, path, partitions)
        # one row per shuffle partition: bounded by configuration, not by the data
        offsets = F.broadcast(_with_offsets(staged.groupBy("_part").count(), "_part"))
        return staged.join(offsets, "_part").select((F.col("_before") + _position() + F.lit(1)).alias(name), *df.columns)
    staged = _slotted_copies(df, order, path, partitions)
    sizes = staged.groupBy("_part").agg(F.sum("_copies").alias("count"))
    offsets = F.broadcast(_with_offsets(sizes, "_part"))
    within = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_copies").over(within), F.lit(0))
    placed = staged.withColumn("_earlier", earlier).join(offsets, "_part")
    return _expanded(placed, F.col("_before") + F.col("_earlier") + F.lit(1), name, df.columns)


def _carried_over(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key in earlier partitions, for keys that partitions share.

    Partitions are sorted, so only the first and last key of each can go on from the
    one before or into the next: at most two rows per partition.
    """
    per_key = staged.groupBy("_part", *keys).agg(F.sum("_copies").alias("_n"), F.min("_slot").alias("_at"))
    ends = per_key.groupBy("_part").agg(*[by(F.struct(*keys, "_n"), "_at").alias(end) for by, end in ((F.min_by, "_head"), (F.max_by, "_tail"))])
    both = ends.select("_part", F.explode(F.array_distinct(F.array("_head", "_tail"))).alias("_end")).select("_part", "_end.*")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return both.select("_part", *keys, F.sum("_n").over(before).alias("_carry")).filter("_carry IS NOT NULL")


def repeat_number(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Adds the number, from 0, of each row among those with equal ``keys`` (none NULL).

    Rows are numbered by ``order``, then by their other columns. They are range-partitioned
    on all of that and written once; a row's number is its place among the rows of its key
    in its partition, plus what earlier partitions have of that key. So a key with very
    many rows is spread over tasks, as are very many equal rows.
    """
    staged = _slotted_copies(df, [*keys, *order], scratch_path(df.sparkSession, "repeats"), None)
    within = Window.partitionBy("_part", *keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_copies").over(within), F.lit(0))
    # at most two rows per shuffle partition: bounded by configuration, not by the data
    carried = F.broadcast(_carried_over(staged, keys))
    placed = staged.withColumn("_earlier", earlier).join(carried, ["_part", *keys], "left")
    return _expanded(placed, F.col("_earlier") + F.coalesce("_carry", F.lit(0)), name, df.columns).select(*df.columns, name)


def surrogate_key(
    df: DataFrame, order_cols: list[str], name: str, *, max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Dense key in natural-key order: one window if small, staged numbering if not."""
    if fits(df, max_rows):
        return ordered_key(df, order_cols, name)
    return global_row_number(df, order_cols, name, unique=False)
