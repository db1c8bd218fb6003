"""Importance resampling towards a target distribution, on hashed word n-grams.

Documents are weighted by how much likelier their n-grams are in the target texts
than in all documents, and drawn without replacement by the Gumbel top-k trick.

Texts become features by Arrow kernels: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode`` give one code per word; n-grams are pairs
of the codes before them and shifted codes; every distinct one is hashed once, and
its bucket's gain is taken for all its places and summed per document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import global_row_number
from .common import stage, text_of

ORDER = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Bytes of text that a task turns into features at once.
BLOCK_BYTES = 4 << 20

# After lower-casing: everything in ASCII but digits and small letters.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BORDER = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Features:
    """Hashed n-grams of a block of texts, in document order.

    ``rows[i]`` is the text of the i-th feature and ``places[i]`` its place among the
    block's distinct n-grams, whose buckets are ``buckets``. ``words`` counts words by
    text. The first ``carried`` words of the first text only stand before others:
    n-grams that end in them were features of the block before.
    """

    def __init__(self, texts: pa.Array, order: int, buckets: int, carried: int = 0) -> None:
        lists = pc.split_pattern_regex(pc.ascii_lower(texts), _SEPARATORS)
        rows, values = pc.list_parent_indices(lists).to_numpy().astype(np.int64), pc.list_flatten(lists)
        real = pc.not_equal(values, "")
        coded = values.filter(real).dictionary_encode()
        rows, codes = rows[real.to_numpy(zero_copy_only=False)], coded.indices.to_numpy().astype(np.int64)
        counts = np.bincount(rows, minlength=len(texts))
        own = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]  # a word's place in its text
        skipped = np.where(rows == 0, carried, 0)
        hashes = np.array([zlib.crc32(word.encode()) for word in coded.dictionary.to_pylist()], np.int64)
        found = [(np.flatnonzero(own >= skipped), codes, hashes)]
        words, grams, ends = [word.encode() for word in coded.dictionary.to_pylist()] if order > 1 else [], codes, np.arange(len(rows))
        for size in range(1, order):
            ends = ends[own[ends] >= size]  # words that end an n-gram of size + 1
            pairs, first, grams_here = np.unique(grams[ends - 1] * max(1, len(words)) + codes[ends], return_index=True, return_inverse=True)
            # the crc of a longer string goes on from that of its beginning
            hashes = np.array(
                [zlib.crc32(b" " + words[pair % len(words)], int(hashes[pair // len(words)])) for pair in pairs.tolist()], np.int64
            )
            grams = np.full(len(rows), -1, np.int64)
            grams[ends] = grams_here
            kept = ends[own[ends] >= skipped[ends]]
            found.append((kept, grams, hashes))
        shift = np.cumsum([0] + [len(h) for _, _, h in found])
        self.rows = np.concatenate([rows[at] for at, _, _ in found])
        self.places = np.concatenate([code[at] + by for (at, code, _), by in zip(found, shift, strict=False)])
        self.buckets = np.concatenate([h for _, _, h in found]) % buckets
        self.words = counts - np.where(np.arange(len(texts)) == 0, carried, 0)

    def counted(self, buckets: int) -> np.ndarray:
        """Number of features in each bucket."""
        return np.bincount(self.buckets[self.places], minlength=buckets)

    def summed(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of features of each text, and the sum of their gains."""
        order = np.argsort(self.rows, kind="stable")
        taken = gains[self.buckets].take(self.places[order])
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.rows, minlength=len(self.words)))])
        sums = np.concatenate([[0], np.cumsum(taken)])
        return np.diff(ends), np.diff(sums[ends])


def _parts(text: str, size: int, order: int) -> Iterator[tuple[str, int]]:
    """A long text in parts, each after the first led by the ``order - 1`` words before it."""
    begin, before = 0, []
    while begin < len(text):
        border = _BORDER.search(text, begin + size) if len(text) - begin > size else None
        end = border.start() if border else len(text)
        yield " ".join([*before, text[begin:end]]), len(before)
        if order > 1:
            before = [*before, *_WORD.findall(text, begin, end)][1 - order :]
        begin = end


def features_of(texts: pa.Array, order: int, buckets: int, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Features]]:
    """Features block by block with the rows of ``texts`` from and up to which they are;
    a text beyond ``size`` makes several blocks of its one row."""
    texts = pc.fill_null(texts, "")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for place, own in enumerate([*lengths.tolist(), 0]):
        full = total and total + own > size
        if (full or own > size or place == len(lengths)) and place > begin:
            yield begin, place, Features(texts.slice(begin, place - begin), order, buckets)
            begin, total = place, 0
        if own > size:
            for part, carried in _parts(texts[place].as_py(), size, order):
                yield place, place + 1, Features(pa.array([part], pa.string()), order, buckets, carried)
            begin, total = place + 1, 0
        else:
            total += own


def bucket_counts(texts: DataFrame, *, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all rows of ``texts`` (column ``text``) by bucket, those that have any.

    A task sums its own rows first, so at most ``buckets`` rows a task are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found in features_of(batch.column(0), order, buckets):
                total += found.counted(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    rows = texts.select(text_of(texts).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, *, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` for every bucket: thousandths of the log ratio of the smoothed
    shares of the bucket in ``target`` and ``docs``, rounded down."""
    ours = bucket_counts(docs, order=order, buckets=buckets).withColumnRenamed("n", "s")
    theirs = bucket_counts(target, order=order, buckets=buckets).withColumnRenamed("n", "t")
    # one row per bucket, a number that is a parameter
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(ours, "bucket", "left").join(theirs, "bucket", "left")
    both = stage(both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "bucket-counts")
    totals = both.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    row = totals.first()
    known = both.withColumns({"all_s": F.lit(row["all_s"]), "all_t": F.lit(row["all_t"])})
    return known.select("bucket", F.floor(1000 * F.ln(ratio)).cast("bigint").alias("gain"))


def weigh(docs: DataFrame, gains: np.ndarray, *, order: int = ORDER) -> DataFrame:
    """Per row ``doc_id, n_words, n_features, weight``; ``gains`` by bucket."""
    kind, buckets = docs.schema["doc_id"].dataType.simpleString(), len(gains)
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for begin, end, found in features_of(batch.column(1), order, buckets):
                sums[:, begin:end] += np.stack([found.words, *found.summed(gains)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(one, pa.int64()) for one in sums]], names=names)

    rows = docs.select("doc_id", text_of(docs).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that a document's id decides, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(name, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    order: int = ORDER,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_features, weight, score, rank``.

    Features are all runs of 1 to ``order`` consecutive words of a whole text (null:
    none), A-Z lower-cased; ``target`` needs a column ``text``. Of the rows with at
    least ``least_words`` words, ``percent`` of a hundred (rounded down) are drawn:
    those of the highest scores, ties to the smaller id; ``rank`` counts them from 1
    and is null elsewhere. Rows of one id share their random number and are drawn
    each for itself, in no stated order where score, features and weight are equal; a
    null id is an id whose text is empty and comes first among ties. Empty tables
    count nothing: without documents the result is empty, without targets the weights
    only say how rare a bucket is. Further columns are passed over.

    Both passes over the texts are narrow; only bucket sums and the scores of the rows
    that may be drawn are shuffled, the latter in ranges.
    """
    gains = bucket_gains(docs, target, order=order, buckets=buckets).orderBy("bucket").collect()  # a parameter's number of rows
    weighed = weigh(docs, np.array([row["gain"] for row in gains], np.int64), order=order)
    scored = stage(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scores")
    may, sum_ = F.col("n_words") >= least_words, scored.filter(F.col("n_words") >= least_words).count()
    ranked = global_row_number(
        scored.filter(may).withColumn("_down", -F.col("score")), ["_down", "doc_id", "n_features", "weight"], "rank", unique=False
    )
    rank = F.when(F.col("rank") <= percent * sum_ // 100, F.col("rank"))
    drawn = ranked.select(*scored.columns, rank.alias("rank"))
    return drawn.unionByName(scored.filter(~may).withColumn("rank", F.lit(None).cast("bigint")))
