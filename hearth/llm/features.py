"""Hashed character n-grams and words of many texts at once, and sums of vectors over a cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches

BLOCK_CHARS = 1 << 19
# Vectors are added up in pieces of so many counts, by so many tasks.
PIECE = 1 << 10
SUM_TASKS = 64
_MULTIPLIERS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)]


@dataclass
class Characters:
    """Code points of a block of texts, each text followed by one blank.

    ``begin[d]`` to ``begin[d + 1]`` are the places of text d, with its blank.
    """

    codes: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, texts: list[str], fold: np.ndarray | None = None) -> Characters:
        """``fold`` maps code points below its length."""
        raw = "".join([t + " " for t in texts]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, dtype="<u4")
        if fold is not None:
            codes = np.where(codes < len(fold), fold[np.minimum(codes, len(fold) - 1)], codes)
        begin = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        return cls(codes.astype(np.uint32), begin)

    def ngrams(self, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the n-gram that begins at each place, and whether it ends within its text's blank."""
        n = len(self.codes)
        total = np.full(n, order, dtype=np.uint32) * np.uint32(0x2545F491)
        for j in range(order):
            rest = max(0, n - j)
            total[:rest] ^= (self.codes[j : j + rest] + np.uint32(j + 1)) * _MULTIPLIERS[j % len(_MULTIPLIERS)]
            total *= np.uint32(0x9E3779B1)
        total ^= total >> np.uint32(15)
        total *= np.uint32(0x85EBCA77)
        whole = np.ones(n, dtype=bool)
        for j in range(1, order):
            ends = self.begin[1:] - j
            whole[ends[ends >= 0]] = False
        return (total >> np.uint32(32 - bits)).astype(np.int32), whole

    def words(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each blank-separated word, and the place where it begins."""
        blank = (self.codes == 32) | ((self.codes >= 9) & (self.codes <= 13))
        starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        if not len(starts):
            return np.zeros(0, dtype=np.int32), starts
        mixed = np.where(blank, 0, self.codes + np.uint32(1)).astype(np.uint64)
        place = np.arange(len(mixed), dtype=np.int64)
        start_of = np.maximum.accumulate(np.where(np.isin(place, starts, assume_unique=True), place, 0))
        weight = (np.uint64(0x9E3779B97F4A7C15) * (place - start_of + 1).astype(np.uint64)) | np.uint64(1)
        spread = (mixed * weight) ^ ((mixed * weight) >> np.uint64(31))
        sums = np.add.reduceat(np.where(blank, np.uint64(0), spread), starts)
        sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (sums >> np.uint64(64 - bits)).astype(np.int32), starts

    def per_text(self, values: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """Sums of ``values`` (at ``places``, or at every place) by text."""
        if places is None:
            return np.add.reduceat(values, self.begin[:-1])
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        bound = np.searchsorted(places, self.begin)
        return sums[bound[1:]] - sums[bound[:-1]]


def text_blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Position of the first text, and texts of about ``BLOCK_CHARS`` characters."""
    begin, part, total = 0, [], 0
    for i, text in enumerate(texts):
        part.append(text)
        total += len(text) + 1
        if total >= BLOCK_CHARS:
            yield begin, part
            begin, part, total = i + 1, [], 0
    if part:
        yield begin, part


def vector_sum(df: DataFrame, local: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of a fixed-size vector of counts over all rows of ``df``.

    Each task adds up its rows and gives one vector, cut into pieces of
    ``PIECE`` counts; the pieces of one place meet in one of ``SUM_TASKS`` tasks.
    No files are written: without Hadoop's native library an executor starts a
    process for each, which for a moment shows the executor's memory a second time.
    """
    bound_batches(df.sparkSession)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += local(batch)
        places = range(0, size, PIECE)
        pieces = [total[at : at + PIECE].tobytes() for at in places]
        yield pa.RecordBatch.from_arrays([pa.array(list(places), pa.int64()), pa.array(pieces, pa.binary())], names=["place", "piece"])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(piece, dtype=np.int64)
                totals[at] = totals[at] + counts if at in totals else counts
        pieces = [total.tobytes() for total in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(pieces, pa.binary())], names=["place", "piece"])

    kind = "place long, piece binary"
    pieces = df.mapInArrow(first, kind).repartition(SUM_TASKS, "place").mapInArrow(further, kind)
    out = np.zeros(size, dtype=np.int64)
    for at, piece in pieces.collect():
        counts = np.frombuffer(piece, dtype=np.int64)
        out[at : at + len(counts)] = counts
    return out


def sampled(key: str, fraction) -> object:
    """Condition that keeps about ``fraction`` of the keys, the same ones every time."""
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < F.lit(float(1 << 30)) * fraction


def held_out(df: DataFrame, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    crc = F.crc32(df["doc_id"].cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))
