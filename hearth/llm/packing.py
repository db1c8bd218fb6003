"""Training sequences of a fixed capacity, by harmonic packing."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder, in_blocks
from .common import stage, text_of

CAPACITY = 1024
END_ID = 0
# Workers whose open bins one worker of the next level takes over.
FAN_IN = 16
# Sequence ids: level, partition and a count within it.
_LEVEL, _PART = 56, 32

_FIELDS = [("doc_tokens", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("ids", pa.list_(pa.int32())), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_SCHEMA = "doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint, ids array<int>, sequence_id bigint, offset bigint"


def piece_lengths(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths that a document of ``tokens`` is cut into: full sequences, then at most
    one half, quarter and eighth of one, then the rest. The first kinds fill their
    bins to the brim; a rest of less than an eighth leaves at most a ninth empty."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    for share in (2, 4, 8):
        size = capacity // share
        if size and rest >= size:
            lengths.append(size)
            rest -= size
    return lengths + [rest] * (rest > 0)


class HarmonicBins:
    """Open bins of one worker: class j holds lengths of (capacity/(j+1), capacity/j],
    and its bin is full at exactly j pieces."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id, self.open = capacity, first_id, {}

    def add(self, piece: tuple) -> list[tuple]:
        """The pieces of the bin that this one fills, with sequence and offset, or none."""
        share = self.capacity // piece[3]
        bin_ = self.open.setdefault(share, [])
        bin_.append(piece)
        return self._close(self.open.pop(share)) if len(bin_) == share else []

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        placed, offset = [], 0
        for piece in pieces:
            placed.append((*piece, self.next_id, offset))
            offset += piece[3]
        self.next_id += 1
        return placed

    def unplaced(self) -> list[tuple]:
        return [(*piece, None, None) for bin_ in self.open.values() for piece in bin_]

    def fit_rest(self) -> list[tuple]:
        """Place what is in open bins (fewer pieces than the classes have places) by first fit, longest first."""
        bins: list[tuple[int, list[tuple]]] = []
        for piece in sorted((p for b in self.open.values() for p in b), key=lambda p: -p[3]):
            for k, (room, pieces) in enumerate(bins):
                if piece[3] <= room:
                    bins[k] = (room - piece[3], [*pieces, piece])
                    break
            else:
                bins.append((self.capacity - piece[3], [piece]))
        self.open = {}
        return [placed for _, pieces in bins for placed in self._close(pieces)]


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (1 + len(_FIELDS))
    kinds = [id_type, *(kind for _, kind in _FIELDS)]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(name for name, _ in _FIELDS)])


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    fan_in: int = FAN_IN,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id,
    offset``, one row per piece; ``ids`` is null unless ``with_ids``. A document's
    tokens are the ids of its whole text (null: empty) and ``end_id``. Each worker
    fills the bins of the harmonic classes on its own and in one pass; what is
    left in its open bins, a few pieces per class, goes on to the next level,
    where one worker takes the open bins of ``fan_in`` workers. The single worker
    of the last level places its last open bins by first fit. Every level is a
    written table, so a lost executor repeats only its own share.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = docs.sparkSession
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, {_SCHEMA}"
    count = F.spark_partition_id()

    def first_id(level: int) -> int:
        return (level << _LEVEL) | (TaskContext.get().partitionId() << _PART)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, bins, id_type = encoder(tokenizer), HarmonicBins(capacity, first_id(0)), None
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            id_type = batch.schema.field(0).type
            doc_ids, begun = iter(batch.column(0).to_pylist()), []
            for texts, rows_here in in_blocks(batch.column(1)):
                found, counts = one.encode(texts)
                if not rows_here:  # a part of a long text
                    begun.append(found)
                    continue
                rows: list[tuple] = []
                for own in np.split(found, np.cumsum(counts)[:-1]):
                    ids, begun = np.concatenate([*begun, own, end]).astype("<u4", copy=False).tobytes(), []
                    doc_id, start, tokens = next(doc_ids), 0, len(ids) // 4
                    for length in piece_lengths(tokens, capacity):
                        piece = ids[4 * start : 4 * (start + length)]
                        values = np.frombuffer(piece, dtype="<u4").astype(np.int32) if with_ids else None
                        rows += bins.add((doc_id, tokens, start, length, zlib.crc32(piece), values))
                        start += length
                yield _batch(rows, id_type)
        if id_type is not None:
            yield _batch(bins.unplaced(), id_type)

    def refill(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, id_type = HarmonicBins(capacity, first_id(level)), None
            for batch in batches:
                id_type = batch.schema.field(0).type
                columns = [batch.column(name).to_pylist() for name in ("doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids")]
                yield _batch([placed for piece in zip(*columns, strict=True) for placed in bins.add(piece)], id_type)
            if id_type is not None:
                yield _batch(bins.fit_rest() if last else bins.unplaced(), id_type)

        return run

    rows = docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(cut, schema)
    level, found = 0, stage(rows.withColumn("worker", count), "pieces")
    done, open_ = found.filter("sequence_id IS NOT NULL"), found.filter("sequence_id IS NULL")
    workers = open_.select("worker").distinct().count()
    while workers:
        level, wanted = level + 1, math.ceil(workers / fan_in)
        moved = open_.drop("worker").coalesce(wanted).mapInArrow(refill(level, wanted == 1), schema)
        found = stage(moved.withColumn("worker", count), "pieces")
        done = done.unionByName(found.filter("sequence_id IS NOT NULL"))
        if wanted == 1:
            break
        open_, workers = found.filter("sequence_id IS NULL"), wanted
    return done.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset")
