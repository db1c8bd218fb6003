"""Boilerplate lines, found with levelled sorted runs of line hashes."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ascii_lower, carried, let, stage, text_of

BLANKS = " \t\n\v\f\r"
MIN_CHARS = 40
MIN_DOCS = 5
# Batches of a small input, and documents a batch of a large one.
BATCHES = 4
BATCH_DOCS = 50_000_000
FANOUT = 3


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


@dataclass
class LineRuns:
    """Levels of sorted runs ``(key, docs, keeper)``, one row per line hash.

    A run is a table bucketed and sorted by the hash, in as many buckets as the
    session has shuffle partitions, so that joining a run and merging two runs are
    merge joins without a shuffle of the run. When a level
    holds ``fanout`` runs, they are merged into one run of the next level. Every
    key whose documents have reached ``min_docs`` in some run is settled: later
    batches leave it out by an anti join, provided that batches arrive from the
    largest document id down, so that its keeper is known already.
    """

    spark: SparkSession
    min_docs: int = MIN_DOCS
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        (
            rows.repartition(self.buckets, "key")
            .write.option("path", scratch_path(self.spark, name))
            .bucketBy(self.buckets, "key")
            .sortBy("key")
            .saveAsTable(name)
        )
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            a, b = rows.alias("a"), self.spark.table(name).alias("b")
            rows = a.join(b, F.col("a.key") == F.col("b.key"), "full_outer").select(
                F.coalesce("a.key", "b.key").alias("key"),
                (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"),
                F.greatest("a.keeper", "b.keeper").alias("keeper"),
            )
        return rows

    def _put(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(full))
            self._forget(full)
            self._put(merged, level + 1)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Add distinct ``(key, doc_id)`` rows of one batch of documents."""
        fresh = batch.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
        for name in self.names():
            settled = self.spark.table(name).filter(F.col("docs") >= self.min_docs).select("key")
            fresh = fresh.join(settled, "key", "left_anti")
        self._put(self._write(fresh), 0)

    def frequent(self) -> DataFrame:
        """Keys of at least ``min_docs`` documents and their keeper; the runs are dropped."""
        names = self.names()
        found = stage(self._merged(names).filter(F.col("docs") >= self.min_docs).select("key", "keeper"), "lines")
        self._forget(names)
        self.levels = []
        return found


def _places(digests: Column, keys: Column) -> Column:
    """Places (from 0) of ``digests``, some null, that are among ``keys``; n log n in both.

    Sorted together, a key stands at the head of its run of equal lines.
    """
    lines = F.filter(F.transform(digests, lambda d, i: F.struct(d.alias("key"), i.alias("at"))), lambda x: x["key"].isNotNull())
    heads = F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(-1).alias("at")))

    def of_runs(ordered: Column) -> Column:
        def head(x: Column, j: Column) -> Column:
            new = F.coalesce(F.get(ordered, j - 1)["key"] != x["key"], F.lit(True))
            return F.struct(j.alias("j"), (x["at"] == -1).alias("is_key"), new.alias("is_new"))

        runs = F.filter(F.transform(ordered, head), lambda x: x["is_new"])

        def found(runs: Column) -> Column:
            def members(x: Column, i: Column) -> Column:
                last = F.coalesce(F.get(runs, i + 1)["j"], F.size(ordered)) - 1
                return F.when(x["is_key"] & (last > x["j"]), F.sequence(x["j"] + 1, last)).otherwise(F.array().cast("array<int>"))

            return F.sort_array(F.transform(F.flatten(F.transform(runs, members)), lambda j: F.get(ordered, j)["at"]))

        return let(runs, found)

    return let(F.sort_array(F.concat(heads, lines)), of_runs)


def _without(lines: Column, places: Column) -> Column:
    """``lines`` but those at ``places``, which are in order."""

    def part(i: Column) -> Column:
        before = F.coalesce(F.get(places, i - 1), F.lit(-1))
        return F.slice(lines, before + 2, F.coalesce(F.get(places, i), F.size(lines)) - before - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), part))


def drop_frequent_lines(
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Lines are the pieces between ``\\n``; a null or empty text is one empty line.
    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines but those in the largest ``doc_id`` that holds
    it (in each row with that id). Documents enter the runs in ``batches`` of
    descending ``doc_id``, by default as many as their number asks for. Keys are
    compared by their 128-bit hash. ``doc_id`` is a number, or null.
    """
    spark = docs.sparkSession
    batches = batches or max(BATCHES, math.ceil(docs.count() / BATCH_DOCS))
    long_lines = (
        docs.select("doc_id", F.explode(F.split(text_of(docs), "\n", -1)).alias("line"))
        .select("doc_id", line_key(F.col("line")).alias("line"))
        .filter(F.length("line") >= min_chars)
        .select(_digest(F.col("line")).alias("key"), "doc_id")
        .distinct()
    )
    bounds = []
    if batches > 1:
        shares = F.array(*[F.lit(i / batches) for i in range(1, batches)])
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares)).collect()[0][0] or ()))
    number = F.lit(0)
    for bound in bounds:
        number = number + F.when(F.col("doc_id") > F.lit(bound), 1).otherwise(0)
    path = scratch_path(spark, "line-keys")
    long_lines.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(f"key binary, doc_id {docs.schema['doc_id'].dataType.simpleString()}, batch int").parquet(path)

    runs = LineRuns(spark, min_docs=min_docs, fanout=fanout)
    for batch in range(len(bounds), -1, -1):
        runs.add(keys.filter(F.col("batch") == batch).select("key", "doc_id"))

    frequent = runs.frequent()
    gone = (
        keys.join(frequent, "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("_line_doc"))
        .agg(F.collect_list("key").alias("_line_keys"))
    )
    lines = F.split(text_of(docs), "\n", -1)

    def digest(line: Column) -> Column:
        return let(line_key(line), lambda key: F.when(F.length(key) >= min_chars, _digest(key)))

    def left(lines: Column) -> Column:
        places = _places(F.transform(lines, digest), F.col("_line_keys"))
        return let(places, lambda found: _without(lines, found))

    kept = F.when(F.col("_line_keys").isNull(), lines).otherwise(let(lines, left))
    return (
        docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_line_doc")), "left")
        .withColumns({"_lines_all": F.size(lines).cast("bigint"), "_lines_kept": kept})
        .select(
            *carried(docs, ["n_lines", "n_dropped", "kept_text"]),
            F.col("_lines_all").alias("n_lines"),
            (F.col("_lines_all") - F.size("_lines_kept")).alias("n_dropped"),
            F.array_join("_lines_kept", "\n").alias("kept_text"),
        )
    )
