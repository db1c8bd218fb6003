"""Exact top-k search by inner product over a vector-approximation file."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE = 1024
TOP = 10
EVERY = 100
CELL_BITS = 6
# Query vectors in a block, and blocks and classes that one task compares.
QUERY_BLOCK = 512
BLOCKS = 64
CHUNK = 1 << 15


def integer_vectors(rows: DataFrame, *, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector, key``: components as floor(scale * x), and a 128-bit digest of them.

    Vectors that are null or hold a null, NaN or infinite component are left out, as are
    rows without an id and vectors with a component so large that a score among such
    vectors would not fit a long (2^30 and more, scaled, for four dimensions); a repeated
    row counts once.
    """
    found = rows.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("x"))
    most = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size("x"), F.lit(1)))
    usable = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < most))
    vector = F.transform("x", lambda x: F.floor(x * scale).cast("bigint"))
    digest = F.unhex(F.md5(F.encode(F.array_join(F.transform("vector", lambda v: v.cast("string")), ","), "UTF-8")))
    found = found.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & usable).select("vec_id", vector.alias("vector"))
    return found.withColumn("key", digest).dropDuplicates(["vec_id", "key"])


def _matrices(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of the lists: which they are, and their values as a matrix."""
    offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        yield at, values[offsets[:-1][at][:, None] + np.arange(d)]


def _binaries(rows: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as binary values."""
    data = np.ascontiguousarray(rows, dtype=np.uint8)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * data.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


class Cells:
    """Grid of the approximation: for each vector length, the least value and the cell width by dimension."""

    def __init__(self, spans: dict[int, tuple[np.ndarray, np.ndarray]], bits: int) -> None:
        self.low = {d: low for d, (low, _) in spans.items()}
        self.width = {d: np.maximum(1, -((low - high - 1) // (1 << bits))) for d, (low, high) in spans.items()}

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        d = vectors.shape[1]
        return ((vectors - self.low[d]) // self.width[d]).astype(np.uint8)

    def corner(self, cells: np.ndarray) -> np.ndarray:
        d = cells.shape[1]
        return self.low[d] + cells.astype(np.float64) * self.width[d]

    def bounds(self, queries: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each query with any vector in each cell."""
        room = (self.width[cells.shape[1]] - 1).astype(np.float64)
        base = queries.astype(np.float64) @ self.corner(cells).T
        slack = 1 + np.abs(base) * 1e-9  # rounding of the products
        low = base + (np.minimum(queries, 0) @ room)[:, None] - slack
        return low, base + (np.maximum(queries, 0) @ room)[:, None] + slack


def _grid(vectors: DataFrame, bits: int) -> Cells:
    """Least and greatest component by length and dimension, over all vectors."""
    spans = (
        vectors.select(F.size("vector").alias("d"), F.posexplode("vector").alias("j", "x"))
        .groupBy("d", "j").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("d", "j").collect()
    )
    found: dict[int, tuple[list, list]] = {0: ([], [])}
    for r in spans:
        low, high = found.setdefault(r["d"], ([], []))
        low.append(r["low"])
        high.append(r["high"])
    return Cells({d: (np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) for d, (a, b) in found.items()}, bits)


def _approximate(classes: DataFrame, grid: Cells) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _matrices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), _binaries(grid.cell(vectors))], names=["cls", "cells"])

    return classes.select("cls", "vector").mapInArrow(run, "cls bigint, cells binary")


def _dealt(cells: DataFrame, queries: DataFrame, block: int, chunk: int) -> DataFrame:
    """Chunks of cells beside groups of query blocks: a task for each pair, cells before blocks.

    ``queries`` is ``key, vector, floor``. The cells go out once per group and a block once
    per chunk, so what is moved is the product of the two sizes over the size of a task.
    """
    counts = cells.agg(F.count(F.lit(1))).first()[0], queries.agg(F.count(F.lit(1))).first()[0]
    chunks, blocks = math.ceil(counts[0] / chunk), math.ceil(counts[1] / block)
    groups = math.ceil(blocks / BLOCKS)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))

    asked = F.collect_list(F.struct("key", "vector", "floor")).alias("asked")
    in_blocks = queries.groupBy(F.size("vector").alias("d"), F.pmod(F.xxhash64("key"), F.lit(max(blocks, 1))).alias("b")).agg(asked)
    question = in_blocks.schema["asked"].dataType
    right = in_blocks.select(
        each(chunks).alias("chunk"), (F.col("b") % max(groups, 1)).cast("int").alias("grp"), F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("cls"), F.lit(None).cast("binary").alias("cells"), "asked",
    )
    left = cells.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.lit(max(chunks, 1))).cast("int")).select(
        "chunk", each(groups).alias("grp"), F.lit(0).alias("kind"), "cls", "cells", F.lit(None).cast(question).alias("asked")
    )
    return left.unionByName(right).repartition("chunk", "grp").sortWithinPartitions("chunk", "grp", "kind")


def _scan(dealt: DataFrame, grid: Cells, what) -> DataFrame:
    """``key, cls, bound``: ``what(low, high, floors)`` of each block over each chunk, as
    query numbers, places of cells and bounds."""

    def compared(held: list[tuple[np.ndarray, list[bytes]]], asked: pa.Scalar) -> Iterator[pa.RecordBatch]:
        keys = [one["key"] for one in asked]
        queries = np.array([one["vector"] for one in asked], dtype=np.int64).reshape(len(keys), -1)
        floors = np.array([-np.inf if one["floor"] is None else one["floor"] for one in asked])
        d = queries.shape[1]
        for classes, cells in held:
            at = np.flatnonzero(np.array([len(c) for c in cells]) == d)
            for part in np.array_split(at, max(1, len(at) * len(keys) // 2_000_000)):
                if len(part):
                    cell = np.frombuffer(b"".join([cells[i] for i in part]), dtype=np.uint8).reshape(len(part), d)
                    q, c, bound = what(*grid.bounds(queries, cell), floors)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()).take(pa.array(q)), pa.array(classes[part][c], pa.int64()), pa.array(bound, pa.float64())],
                        names=["key", "cls", "bound"],
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list[bytes]]] = []
        now = None
        for batch in batches:
            where = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for rows in np.split(np.arange(batch.num_rows), cuts):
                if not len(rows):
                    continue
                pair, kind = tuple(where[rows[0], :2].tolist()), int(where[rows[0], 2])
                if pair != now:
                    held, now = [], pair
                some = batch.slice(int(rows[0]), len(rows))
                if kind == 0:
                    held.append((some.column(3).to_numpy(), some.column(4).to_pylist()))
                else:
                    for asked in some.column(5).to_pylist():
                        yield from compared(held, asked)

    return dealt.mapInArrow(run, "key binary, cls bigint, bound double")


def _ranked(partition: list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def _candidates(cells: DataFrame, grid: Cells, wanted: DataFrame, need: int, block: int, chunk: int) -> DataFrame:
    """``key, cls, bound``: every class whose greatest score reaches the ``need``-th largest least score."""

    def best_low(low, high, floors):
        n = min(need, low.shape[1])
        at = np.argpartition(-low, n - 1, axis=1)[:, :n]
        return np.repeat(np.arange(len(low)), n), at.ravel(), np.take_along_axis(low, at, axis=1).ravel()

    def within(low, high, floors):
        q, c = np.nonzero(high >= floors[:, None])
        return q, c, high[q, c]

    asked = wanted.select("key", "vector", F.lit(None).cast("double").alias("floor"))
    lows = _scan(_dealt(cells, asked, block, chunk), grid, best_low).withColumn("rank", _ranked(["key"], F.desc("bound")))
    sure = lows.filter(F.col("rank") <= need).groupBy("key").agg(F.when(F.count(F.lit(1)) == need, F.min("bound")).alias("floor"))
    known = wanted.select("key", "vector").join(stage(sure, "lows"), "key", "left")
    return _scan(_dealt(cells, stage(known, "asked"), block, chunk), grid, within)


def search(
    rows: DataFrame,
    *,
    top: int = TOP,
    every: int = EVERY,
    scale: int = SCALE,
    bits: int = CELL_BITS,
    block: int = QUERY_BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best rows for each row whose ``vec_id`` is divisible by ``every``.

    Equal vectors form a class, which is searched once: of a class only its
    ``top + 1`` smallest ids can be among the best of any query. The
    approximation file holds each class's cell on a grid over all vectors. It is
    compared with the distinct query vectors twice, chunk by block, in one job each:
    first for the best sure scores, then for all classes that may reach them. Exact vectors are read in the order
    of their bounds: first the best ``top + 1`` classes of each query, then every
    class whose bound still reaches the last of those scores; nothing else can
    be among the best.

    Scores are integer inner products (exact while they fit a long); ties go to
    the smaller ``vec_id``. Rows with the query's own id are not its candidates,
    vectors of another length have no score, and repeated rows count once.
    """
    need = top + 1
    vectors = stage(integer_vectors(rows, scale=scale), "vectors")
    members = stage(
        vectors.select("key", "vec_id").withColumn("rank", _ranked(["key"], F.col("vec_id")))
        .filter(F.col("rank") <= need).groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("members")),
        "members",
    )
    distinct = stage(
        vectors.join(members, "key").filter(F.col("vec_id") == F.col("members")[0])
        .select("key", "vector", "members").withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    grid = _grid(distinct, bits)
    cells = stage(_approximate(distinct, grid), "cells")

    asked = vectors.filter(F.col("vec_id") % every == 0).select("key", F.col("vec_id").alias("query_id"))
    wanted = stage(distinct.join(asked.select("key").distinct(), "key").select("key", "vector"), "queries")
    found = stage(_candidates(cells, grid, wanted, need, block, chunk), "candidates")
    ordered = found.withColumn("place", _ranked(["key"], F.desc("bound"), F.col("cls")))
    first = _scored(ordered.filter(F.col("place") <= need), distinct, wanted)
    sure = stage(
        first.select("key", "score", F.explode("members")).withColumn("place", _ranked(["key"], F.desc("score")))
        .filter(F.col("place") <= need).groupBy("key")
        .agg(F.when(F.count("*") == need, F.min("score")).alias("floor")),
        "floors",
    )
    left = found.join(sure, "key").filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
    best = (
        _scored(left, distinct, wanted).select("key", "score", F.explode("members").alias("vec_id"))
        .withColumn("place", _ranked(["key"], F.desc("score"), F.col("vec_id"))).filter(F.col("place") <= need)
        .groupBy("key").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("best"))
    )
    results = stage(best, "best")
    return (
        asked.join(results, "key")
        .withColumn("own", F.filter(F.array_sort("best"), lambda x: x["vec_id"] != F.col("query_id")))
        .select("query_id", F.posexplode(F.slice("own", 1, top)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )


def _scored(candidates: DataFrame, distinct: DataFrame, wanted: DataFrame) -> DataFrame:
    """Exact scores of candidate classes."""
    product = F.aggregate(F.zip_with("asked", "vector", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return (
        candidates.select("key", "cls")
        .join(wanted.select("key", F.col("vector").alias("asked")), "key")
        .join(distinct.select("cls", "vector", "members"), "cls")
        .select("key", product.alias("score"), "members")
    )
