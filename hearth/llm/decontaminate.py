"""Benchmark passages in documents, by a prefix-filtered set join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .wordhash import blocks, byte_class, mix, texts_of, words_of

WINDOW = 10
SHINGLE = 3
# Bits of the membership map that goes to every task: its size is fixed, and a
# larger benchmark only makes it let more positions through to the join.
MAP_BITS = 1 << 25
WORD_BYTES = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) & np.uint64(MAP_BITS - 1)).astype(np.int64)


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct ``(item_id, words, tokens, size)``: each window with its shingle hashes.

    ``size`` is the number of words of a shingle, fewer than ``shingle`` only in
    items shorter than that.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            rows = []
            for item, text in zip(ids, texts, strict=True):
                found = words_of([text], WORD_BYTES)
                n = len(found.starts)
                length, size = min(window, n), min(shingle, n)
                if not n:
                    continue
                tokens = found.shingles(size)[0].view(np.int64)
                words = [found.text(i).decode() for i in range(n)]
                for i in range(n - length + 1):
                    rows.append((item, words[i : i + length], tokens[i : i + length - size + 1].tolist(), size))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.list_(pa.string())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.int32()),
                ],
                names=["item_id", "words", "tokens", "size"],
            )

    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    return rows.mapInArrow(cut, "item_id string, words array<string>, tokens array<bigint>, size int").distinct()


def _membership(tokens: DataFrame) -> np.ndarray:
    """Bits of the slots of a ``token`` column; at most ``MAP_BITS`` / 64 rows reach the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_slot(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(slot)], names=["slot"])

    packed = (
        tokens.select("token").mapInArrow(slots, "slot bigint").distinct()
        .groupBy((F.shiftright("slot", 6)).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(MAP_BITS // 64, dtype=np.int64)
    bits[packed.column("word").to_numpy()] = packed.column("bits").to_numpy()
    return bits.view(np.uint64)


def _hits(batch_texts: list[bytes], sizes: list[int], bits: np.ndarray):
    """Per block: its range of texts, its words, and (token, word position) of the mapped shingles."""
    for begin, end in blocks(batch_texts):
        found = words_of(batch_texts[begin:end], WORD_BYTES)
        tokens, places = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for size in sizes:
            token, whole = found.shingles(size)
            slot = _slot(token)
            hit = np.flatnonzero(whole & ((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool))
            tokens.append(token[hit])
            places.append(hit)
        yield begin, end, found, np.concatenate(tokens), np.concatenate(places)


def _frequencies(docs: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """How often each mapped shingle occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [t for *_, t, _ in _hits(texts_of(batch.column(0)), sizes, bits)]
            token, n = np.unique(np.concatenate([*tokens, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])

    return docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


HITS = "array<struct<token:bigint,place:int,lead:int,context:array<string>>>"


def _candidates(docs: DataFrame, sizes: list[int], bits: np.ndarray, window: int) -> DataFrame:
    """One row per document: ``doc_id, n_words`` and the places of prefix shingles, each
    with the words from ``lead`` words before it to a window after it."""
    kind = pa.list_(
        pa.struct([("token", pa.int64()), ("place", pa.int32()), ("lead", pa.int32()), ("context", pa.list_(pa.string()))])
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            n_words, hits = np.zeros(len(texts), dtype=np.int64), [[] for _ in texts]
            for begin, end, found, tokens, places in _hits(texts, sizes, bits):
                n_words[begin:end] = np.diff(found.first)
                owner = np.searchsorted(found.first, places, side="right") - 1
                for token, at, doc in zip(tokens.view(np.int64).tolist(), places.tolist(), owner.tolist(), strict=True):
                    first, last = int(found.first[doc]), int(found.first[doc + 1])
                    low = max(first, at - window + 1)
                    context = [found.text(i).decode() for i in range(low, min(last, at + window))]
                    hits[begin + doc].append({"token": token, "place": at - first, "lead": at - low, "context": context})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(hits, kind)], names=["doc_id", "n_words", "hits"]
            )

    rows = docs.select("doc_id", "text").mapInArrow(look, f"doc_id {id_type}, n_words bigint, hits {HITS}")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "places")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items, contaminated``.

    A window is ``window`` consecutive words of an item, or the whole item if it
    is shorter. Every window is the set of its shingles, and it can occur only
    where all of them do; so its prefix is its rarest shingle over all
    documents, and a window whose rarest shingle occurs nowhere is left out. The
    documents' places of prefix shingles are joined with the windows; offset and
    document length bound where a window may lie, and the words themselves
    decide. ``n_hit`` counts the words inside any occurrence, ``items`` lists
    the ids (as strings) of items with an occurring window, sorted. Nulls and
    texts without words have no words; a null ``item_id`` is the empty id.
    """
    windows = stage(item_windows(benchmark, window, shingle).withColumn("window", F.monotonically_increasing_id()), "windows")
    sizes = [r[0] for r in windows.select("size").distinct().orderBy("size").collect()]
    parts = windows.select("window", F.posexplode("tokens").alias("offset", "token"))
    frequencies = _frequencies(docs, sizes, _membership(parts))
    prefix = (
        parts.join(frequencies, "token")
        .groupBy("window")
        .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("n", "token", "offset")).alias("rarest"))
    )
    wanted = stage(
        windows.join(prefix, "window")
        .filter(F.col("present") == F.size("tokens"))
        .select("item_id", "words", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset")),
        "prefixes",
    )
    rows = _candidates(docs, sizes, _membership(wanted), window)

    length = F.size("words")
    begin = F.col("hit.place") - F.col("offset")
    occurring = (
        rows.select("row", "n_words", F.explode("hits").alias("hit"))
        .withColumn("token", F.col("hit.token"))
        .join(wanted, "token")
        .filter((begin >= 0) & (begin + length <= F.col("n_words")) & (F.col("offset") <= F.col("hit.lead")))
        .filter(F.slice("hit.context", F.col("hit.lead") - F.col("offset") + 1, length) == F.col("words"))
        .groupBy("row")
        .agg(
            F.collect_set(F.struct(begin.alias("begin"), length.alias("length"))).alias("spans"),
            F.collect_set(F.coalesce("item_id", F.lit(""))).alias("items"),
        )
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["begin"] + s["length"] - 1)))
    found = occurring.select(
        "row", F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"), F.array_sort("items").alias("items")
    )
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
