"""Joins of the star schema.

Equi joins carry no hint: Spark broadcasts a side only when its own size
estimate, or the measured size under adaptive execution, is below the session
threshold, and splits skewed partitions otherwise. A hint is given only after
:func:`hearth.sizing.fits` has counted the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sizing import SMALL_ROWS, fits

# Days per bucket of the validity join. With versions that do not overlap, a
# fact row meets at most this many candidates plus one.
BUCKET_DAYS = 32


def key_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Fact to one dimension on a surrogate key of the same name."""
    return fact.join(dim, key, how)


def star_join(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact to several dimensions, each on its surrogate key."""
    return reduce(lambda left, one: key_join(left, one[1], one[0]), dims.items(), fact)


def instant_join(left: DataFrame, dim_time: DataFrame, hour: str = "hour_start") -> DataFrame:
    """Hourly rows to the calendar on the hour instant."""
    return left.join(dim_time.withColumnRenamed("HourTs", hour), hour)


def hour_join(left: DataFrame, right: DataFrame, hour: str) -> DataFrame:
    """Keeps every left hour; right measures are NULL where nothing matches."""
    return left.join(right, hour, "left")


def flag_join(left: DataFrame, days: DataFrame, on: str, flag: str) -> DataFrame:
    """Adds whether ``on`` occurs in the single-column frame ``days``."""
    known = days.select(F.col(days.columns[0]).alias("_known")).distinct()
    joined = left.join(known, F.col(on) == F.col("_known"), "left")
    return joined.withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def _versions(
    dim: DataFrame, start: str, end: str, keys: Sequence[tuple[str, str]], carry: Sequence[str]
) -> DataFrame:
    return dim.select(
        F.col(start).alias("_from"),
        F.col(end).alias("_to"),
        *[F.col(dim_key).alias(f"_key{i}") for i, (_, dim_key) in enumerate(keys)],
        *carry,
    )


def _by_bucket(
    fact: DataFrame,
    dim: DataFrame,
    day: str,
    start: str,
    end: str,
    carry: Sequence[str],
    keys: Sequence[tuple[str, str]],
    bucket_days: int,
) -> tuple[DataFrame, DataFrame, Column]:
    """Fact with its bucket, versions repeated per bucket, and the join condition.

    Each version is repeated once per bucket it touches. Beyond the last start
    date in the dimension nothing changes any more, so all later days share one
    tail bucket and an open end costs a single row; the fact itself is not
    scanned for its date range.
    """
    versions = _versions(dim, start, end, keys, carry)
    numbered = lambda col: F.floor(F.unix_date(col) / F.lit(bucket_days))
    tail = versions.agg(F.max(numbered(F.col("_from"))).alias("last_change")).scalar() + F.lit(1)
    bucket = lambda col: F.least(numbered(col), tail)
    touched = F.when(F.col("_from") <= F.col("_to"), F.sequence(bucket(F.col("_from")), bucket(F.col("_to"))))
    repeated = versions.withColumn("_bucket", F.explode(touched))
    placed = fact.withColumn("_fact_bucket", bucket(F.col(day)))
    valid = F.col(day).between(F.col("_from"), F.col("_to"))
    same_bucket = F.col("_fact_bucket") == F.col("_bucket")
    same_keys = [F.col(fact_key) == F.col(f"_key{i}") for i, (fact_key, _) in enumerate(keys)]
    return placed, repeated, reduce(lambda a, b: a & b, [*same_keys, same_bucket, valid])


def validity_join(
    fact: DataFrame,
    dim: DataFrame,
    day: str,
    start: str,
    end: str,
    *,
    carry: Sequence[str],
    keys: Sequence[tuple[str, str]] = (),
    bucket_days: int = BUCKET_DAYS,
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Versions valid on the fact's day, ``start <= day <= end``, as a hash join.

    The repeated versions are broadcast after they were counted to be few;
    otherwise both sides are shuffled as in :func:`validity_join_bucketed`.
    """
    placed, repeated, condition = _by_bucket(fact, dim, day, start, end, carry, keys, bucket_days)
    few = fits(repeated, max_rows)
    repeated = F.broadcast(repeated) if few else repeated.hint("merge")
    return placed.join(repeated, condition).select(*fact.columns, *carry)


def validity_join_bucketed(
    fact: DataFrame,
    dim: DataFrame,
    day: str,
    start: str,
    end: str,
    *,
    carry: Sequence[str],
    keys: Sequence[tuple[str, str]] = (),
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """Validity join for a large dimension: shuffled on keys and day bucket.

    Buckets spread a hot key over many shuffle partitions. The repeated side is
    never broadcast, because Spark's estimate does not see the repetition.
    """
    placed, repeated, condition = _by_bucket(fact, dim, day, start, end, carry, keys, bucket_days)
    return placed.join(repeated.hint("merge"), condition).select(*fact.columns, *carry)


def overlapping_versions(
    left: DataFrame, right: DataFrame, days: DataFrame, *, bucket_days: int = BUCKET_DAYS
) -> DataFrame:
    """Pairs of versions from two dimensions that share a day of ``days``.

    What a cross join with a date filter selects, as two equi joins: each side
    is matched to the days it covers, and the days meet on equality.
    ``left`` and ``right`` have columns ``(key, from, to)``, ``days`` has one.
    """
    day = days.columns[0]
    on_days = days.distinct()
    matched = on_days
    for side in (left, right):
        key, start, end = side.columns
        matched = validity_join(matched, side, day, start, end, carry=[key], bucket_days=bucket_days)
    return matched.groupBy(left.columns[0], right.columns[0]).agg(F.count("*").alias("days"))


def outer_merge(frames: Sequence[DataFrame], on: str) -> DataFrame:
    """Full outer join of all frames on one column.

    Rows without a key match nothing; they are added after the joins, so they
    neither meet in one task nor multiply.
    """

    def merge(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, on, "full_outer")

    merged = reduce(merge, [frame.filter(F.col(on).isNotNull()) for frame in frames])
    keyless = [frame.filter(F.col(on).isNull()) for frame in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), keyless, merged)


def semi_members(df: DataFrame, col: str, members: DataFrame) -> DataFrame:
    """Rows whose ``col`` occurs in the single-column frame ``members``."""
    known = members.select(F.col(members.columns[0]).alias(col))
    return df.join(known, col, "left_semi")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("_pk"), "left_anti")
