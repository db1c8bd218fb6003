"""Repeated byte strings across documents, decided in suffix order by external induced sorting."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stage, text_of
from .induced_sort import suffix_order
from .wordhash import mix, prefix_hash, texts_of

MATCH = 50
# Bytes of an anchor. Every string of MATCH bytes holds the anchor of least hash
# in it, so equal strings lie around equal anchors.
ANCHOR = 24
# Bytes of spans that a shard sorts at a time. An anchor that may have more is split.
GROUP_BYTES = 1 << 19
# Bytes of text for which there is a shard, whatever the session's shuffle partitions are.
SHARD_BYTES = 32 << 20
LEAST_ID = -(1 << 63)
_HOME = 33  # class numbers: partition, and place in it


def _anchors(data: np.ndarray, match: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts [begin, end) with one least anchor: its hash, and a hash of all bytes the run spans."""
    n = len(data) - match + 1
    if n <= 0:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) * 2
    sums, down = prefix_hash(data)
    low = mix((sums[anchor:] - sums[:-anchor]) * down[: len(data) - anchor + 1])
    width, size = match - anchor + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[width - size : width - size + n])
    new = np.concatenate([[True], low[1:] != low[:-1]])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, n))
    if length.max() > width:  # a periodic text: no run spans more than two strings
        own = np.arange(n) - np.repeat(begin, length)
        begin = np.flatnonzero(new | (own % width == 0))
        length = np.diff(np.append(begin, n))
    end = begin + length
    return begin, end, low[begin], mix((sums[end - 1 + match] - sums[begin]) * down[begin] + length.astype(np.uint64))


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each start in the runs [begin, end), and two hashes of its ``match`` bytes: one of sums,
    one of the bytes as words, which have nothing in common."""
    sums, down = prefix_hash(data)
    n = end - begin
    starts = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    second = np.full(len(starts), match, dtype=np.uint64)
    for at in range(0, match, 8):
        word = np.zeros(len(starts), dtype=np.uint64)
        for j in range(at, min(at + 8, match)):
            word = word << np.uint64(8) | data[starts + j].astype(np.uint64)
        second = mix(second * np.uint64(0x9E3779B97F4A7C15) ^ word)
    return starts, mix((sums[starts + match] - sums[starts]) * down[starts] + np.uint64(1)), second


def _held(anchors: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different anchors of a text, the number of different contents of each, and a tag of these contents."""
    order = np.lexsort((content, anchors))
    anchors, content = anchors[order], content[order]
    new = np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)]
    other = new | np.concatenate([[True], content[1:] != content[:-1]])[: len(anchors)]
    if not len(anchors):
        return anchors, np.zeros(0, dtype=np.int64), anchors
    first = np.flatnonzero(new)
    tags = np.add.reduceat(np.where(other, content, np.uint64(0)), first) >> np.uint64(32)
    return anchors[first], np.add.reduceat(other.astype(np.int64), first), tags


def _table(spark: SparkSession, docs: DataFrame) -> str:
    """Distinct texts ``(digest, doc_id, cls, packed)`` with their smallest id, bucketed and sorted by digest."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()), pa.array([press.compress(t) for t in texts], pa.binary())],
                names=["doc_id", "digest", "packed"],
            )

    name = f"texts_{uuid.uuid4().hex[:12]}"
    (
        docs.mapInArrow(pack, "doc_id bigint, digest binary, packed binary")
        .groupBy("digest").agg(F.min(F.struct("doc_id", "packed")).alias("one"))
        .select("digest", "one.doc_id", F.monotonically_increasing_id().alias("cls"), "one.packed")
        .write.option("path", scratch_path(spark, "texts")).option("compression", "none")
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "digest").sortBy("digest").saveAsTable(name)
    )
    return name


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
        if len(part):
            yield int(keys[part[0]]), part


class _Blobs:
    """Arrays of one length, dealt by a key into rows of binaries."""

    def __init__(self, key: str, kinds: dict[str, str]) -> None:
        self.key, self.kinds = key, kinds
        self.schema = f"{key} int, " + ", ".join(f"{name} binary" for name in kinds)

    def rows(self, keys: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
        found = [(key, [columns[name][at].astype(kind).tobytes() for name, kind in self.kinds.items()]) for key, at in _groups(keys)]
        arrays = [pa.array([key for key, _ in found], pa.int32())]
        arrays += [pa.array([values[i] for _, values in found], pa.binary()) for i in range(len(self.kinds))]
        return pa.RecordBatch.from_arrays(arrays, names=[self.key, *self.kinds])

    def read(self, batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        """All rows of the partition together; ``key`` is repeated for each element."""
        parts: dict[str, list[bytes]] = {name: [] for name in self.kinds}
        keys, sizes = [], []
        first, width = next(iter(self.kinds)), np.dtype(next(iter(self.kinds.values()))).itemsize
        for batch in batches:
            keys += batch.column(self.key).to_pylist()
            for name in self.kinds:
                parts[name] += batch.column(name).to_pylist()
            sizes += [len(x) // width for x in batch.column(first).to_pylist()]
        out = {name: np.frombuffer(b"".join(parts[name]), dtype=kind) for name, kind in self.kinds.items()}
        return out | {self.key: np.repeat(np.array(keys, dtype=np.int64), sizes)}


def _bucket(anchors: np.ndarray, n: int) -> np.ndarray:
    return ((anchors >> np.uint64(20)) % np.uint64(n)).astype(np.int32)


_ENTRIES = _Blobs("bucket", {"anchor": "<u8", "low": "<u4", "home": "<i4", "n": "<u2", "tag": "<u4"})
_SHARED = _Blobs("home", {"low": "<u4", "anchor": "<u8", "hot": "?"})
_REMOVED = _Blobs("home", {"low": "<u4", "begin": "<u4", "end": "<u4"})


def _hot(e: dict[str, np.ndarray], shared: np.ndarray, most: int) -> np.ndarray:
    """Which of the entries ``shared``, in order of anchors, are of an anchor with more than ``most`` different contents.

    Classes with the same contents count once, other classes with their sum: the bound is never too low.
    """
    out = np.zeros(len(shared), dtype=bool)
    anchors = e["anchor"][shared]
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)])
    if len(first):
        stop = np.append(first[1:], len(anchors))
        for i in np.flatnonzero(np.add.reduceat(e["n"][shared].astype(np.int64), first) > most):
            at = shared[first[i] : stop[i]]
            kinds = np.unique(e["tag"][at].astype(np.int64) << 16 | e["n"][at])
            out[first[i] : stop[i]] = (kinds & 0xFFFF).sum() > most
    return out


def _shared_anchors(texts: DataFrame, buckets: int, match: int, anchor: int, group: int = GROUP_BYTES) -> DataFrame:
    """``cls, anchors, hot``: for each class the anchors that other classes hold too, and those
    of them whose different spans may exceed ``group`` bytes."""
    most = group // (2 * match - anchor + 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            classes = batch.column(0).to_numpy()
            found = [_held(*_anchors(np.frombuffer(unpack.decompress(p), dtype=np.uint8), match, anchor)[2:]) for p in batch.column(1).to_pylist()]
            anchors, n, tags = [np.concatenate([*[f[i] for f in found], np.zeros(0, kind)]) for i, kind in enumerate((np.uint64, np.int64, np.uint64))]
            owner = np.repeat(classes, [len(f[0]) for f in found])
            yield _ENTRIES.rows(
                _bucket(anchors, buckets), anchor=anchors, low=owner & ((1 << _HOME) - 1), home=owner >> _HOME, n=np.minimum(n, 0xFFFF), tag=tags
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _ENTRIES.read(batches)
        order = np.argsort(e["anchor"])
        a = e["anchor"][order]
        same = a[1:] == a[:-1]
        shared = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(a) else order
        yield _SHARED.rows(e["home"][shared], low=e["low"][shared], anchor=e["anchor"][shared], hot=_hot(e, shared, most))

    def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _SHARED.read(batches)
        classes = (e["home"] << _HOME) | e["low"].astype(np.int64)
        found = [(key, e["anchor"][at].tobytes(), e["anchor"][at[e["hot"][at]]].tobytes()) for key, at in _groups(classes)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["cls", "anchors", "hot"]
        )

    entries = texts.select("cls", "packed").mapInArrow(emit, _ENTRIES.schema).repartition("bucket")
    return entries.mapInArrow(meet, _SHARED.schema).repartition("home").mapInArrow(give_back, "cls bigint, anchors binary, hot binary")


_PIECES = "bucket int, home binary, low binary, doc_id binary, start binary, anchor binary, content binary, first binary, length binary, bytes binary"
_PIECE_KINDS = {"home": "<i4", "low": "<u4", "doc_id": "<i8", "start": "<u4", "anchor": "<u8", "content": "<u8", "first": "?", "length": "<u2"}


def _pieces(texts: DataFrame, buckets: int, match: int, anchor: int) -> DataFrame:
    """Spans around shared anchors, by bucket of the anchor; equal spans of a batch bring their bytes once.

    Around a hot anchor each string of ``match`` bytes is a span of its own, with two hashes
    as anchor and content: equal strings meet, strings that differ in either are different,
    and as no such span has to be sorted, it brings no bytes.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in _PIECE_KINDS}
            spans: list[bytes] = []
            sorts: list[np.ndarray] = []
            for cls, doc_id, packed, shared, hot in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = unpack.decompress(packed)
                data = np.frombuffer(raw, dtype=np.uint8)
                runs = _anchors(data, match, anchor)
                at = np.flatnonzero(np.isin(runs[2], np.frombuffer(shared, dtype="<u8")))
                begin, end, anchors, content = [x[at] for x in runs]
                end = end - 1 + match
                sort = np.ones(len(at), dtype=bool)
                if hot:
                    split = np.isin(anchors, np.frombuffer(hot, dtype="<u8"))
                    starts, *hashes = _strings(data, begin[split], end[split] + 1 - match, match)
                    added = (starts, starts + match, *hashes)
                    begin, end, anchors, content = [np.concatenate([x[~split], y]) for x, y in zip((begin, end, anchors, content), added, strict=True)]
                    sort = np.arange(len(begin)) < len(begin) - len(starts)
                spans += [raw[b:e] if s else b"" for b, e, s in zip(begin.tolist(), end.tolist(), sort.tolist(), strict=True)]
                sorts.append(sort)
                for name, value in (("home", cls >> _HOME), ("low", cls & ((1 << _HOME) - 1)), ("doc_id", doc_id)):
                    columns[name].append(np.full(len(begin), value))
                for name, values in (("start", begin), ("anchor", anchors), ("content", content), ("length", end - begin)):
                    columns[name].append(values)
            if not spans:
                continue
            e = {name: np.concatenate(parts) for name, parts in columns.items() if parts}
            e["first"] = np.zeros(len(spans), dtype=bool)
            e["first"][np.unique(np.stack([e["anchor"], e["content"]]), axis=1, return_index=True)[1]] = True
            e["first"] &= np.concatenate(sorts)
            rows = []
            for key, at in _groups(_bucket(e["anchor"], buckets)):
                held = press.compress(b"".join([spans[i] for i in at[e["first"][at]]]))
                rows.append([key, *[e[name][at].astype(kind).tobytes() for name, kind in _PIECE_KINDS.items()], held])
            kinds = [pa.int32(), *[pa.binary()] * (len(_PIECE_KINDS) + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["bucket", *_PIECE_KINDS, "bytes"]
            )

    return texts.select("cls", "doc_id", "packed", "anchors", "hot").mapInArrow(emit, _PIECES)


def _least_owner(spans: list[bytes], owners: np.ndarray, match: int) -> list[np.ndarray]:
    """For each start in each span: the least owner of a span with the same ``match`` bytes."""
    lengths = np.array([len(s) for s in spans], dtype=np.int64)
    raw = np.frombuffer(b"".join([s + b"\0" for s in spans]), dtype=np.uint8)
    text = raw.astype(np.int32) + 2
    ends = np.cumsum(lengths + 1) - 1
    text[ends] = 1
    order, shared = suffix_order(np.append(text, np.int32(0)))
    room = np.repeat(ends, lengths + 1) - np.arange(len(text))
    least = np.repeat(owners, lengths + 1)
    group = np.cumsum(shared < match) - 1  # neighbours in suffix order that share a whole string
    inside = order < len(text)
    order, group = order[inside], group[inside]
    keep = room[order] >= match
    order, group = order[keep], group[keep]
    if len(order):
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        values = np.minimum.reduceat(least[order], first)
        least[order] = np.repeat(values, np.diff(np.append(first, len(order))))
    begins = ends - lengths
    return [least[b : b + n - match + 1] for b, n in zip(begins.tolist(), lengths.tolist(), strict=True)]


def _decide(e: dict[str, np.ndarray], held: list[bytes], match: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which bytes of the pieces of one shard go: pieces, and for each [begin, end) in its text."""
    span_of = np.cumsum(e["first"]) - 1
    order = np.lexsort((e["doc_id"], ~e["first"], e["content"], e["anchor"]))
    anchors, contents = e["anchor"][order], e["content"][order]
    new_anchor = np.concatenate([[True], anchors[1:] != anchors[:-1]])
    new = new_anchor | np.concatenate([[True], contents[1:] != contents[:-1]])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(e["doc_id"][order], first)
    # an anchor with one content needs no order: all its strings are those of the least owner
    of_anchor = (np.cumsum(new_anchor) - 1)[first]
    # strings of a split anchor came without bytes: their two hashes tell them apart
    several = (np.bincount(of_anchor)[of_anchor] > 1) & e["first"][order][first]
    starts = (e["length"][order][first].astype(np.int64) - match + 1)
    owner: list[np.ndarray] = [np.full(n, x) for n, x in zip(starts.tolist(), least.tolist(), strict=True)]
    chosen = np.flatnonzero(several)
    # anchors have no string in common, so they are sorted in groups of about GROUP_BYTES;
    # those of more are split, and their strings have one content each
    room = np.cumsum(e["length"][order][first[chosen]].astype(np.int64) + 1) // GROUP_BYTES
    of_chosen = of_anchor[chosen]
    begins = np.flatnonzero(np.concatenate([[True], of_chosen[1:] != of_chosen[:-1]])[: len(chosen)])
    part = np.repeat(room[begins], np.diff(np.append(begins, len(chosen))))
    for at in np.split(chosen, np.flatnonzero(np.diff(part)) + 1):
        if len(at):
            spans = [held[span_of[order[first[i]]]] for i in at]
            for i, found in zip(at.tolist(), _least_owner(spans, least[at], match), strict=True):
                owner[i] = found
    flat, offset = np.concatenate(owner), np.concatenate([[0], np.cumsum(starts)])
    for part in np.array_split(np.arange(len(order)), max(1, len(order) // 100_000)):
        n = starts[group[part]]
        rows = np.repeat(part, n)
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        gone = flat[offset[group[rows]] + inner] < e["doc_id"][order[rows]]
        # runs of starts to remove
        edge = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (rows[1:] == rows[:-1])]))
        stop = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (rows[1:] == rows[:-1]), [False]]))
        piece = order[rows[edge]]
        begin = e["start"][piece].astype(np.int64) + inner[edge]
        end = e["start"][piece].astype(np.int64) + inner[stop] + match
        yield piece, begin, end


def _removed(pieces: DataFrame, match: int) -> DataFrame:
    """``cls, spans``: merged byte spans to remove, as pairs of unsigned 32-bit numbers."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        parts: dict[str, list[bytes]] = {name: [] for name in _PIECE_KINDS}
        held: list[bytes] = []
        for batch in batches:
            for name in _PIECE_KINDS:
                parts[name] += batch.column(name).to_pylist()
            for packed, first, length in zip(batch.column("bytes").to_pylist(), batch.column("first").to_pylist(), batch.column("length").to_pylist(), strict=True):
                raw, at = unpack.decompress(packed), 0
                for n in np.frombuffer(length, dtype="<u2")[np.frombuffer(first, dtype="?")].tolist():
                    held.append(raw[at : at + n])
                    at += n
        e = {name: np.frombuffer(b"".join(parts[name]), dtype=kind) for name, kind in _PIECE_KINDS.items()}
        if not len(e["anchor"]):
            return
        for piece, begin, end in _decide(e, held, match):
            yield _REMOVED.rows(e["home"][piece], low=e["low"][piece], begin=begin, end=end)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _REMOVED.read(batches)
        classes, spans = [], []
        for cls, at in _groups((e["home"] << _HOME) | e["low"].astype(np.int64)):
            at = at[np.argsort(e["begin"][at], kind="stable")]
            begin, end = e["begin"][at].astype(np.int64), np.maximum.accumulate(e["end"][at].astype(np.int64))
            new = np.concatenate([[True], begin[1:] > end[:-1]])
            stop = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
            classes.append(cls)
            spans.append(np.stack([begin[new], end[stop]], axis=1).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(spans, pa.binary())], names=["cls", "spans"])

    return pieces.repartition("bucket").mapInArrow(sort, _REMOVED.schema).repartition("home").mapInArrow(merge, "cls bigint, spans binary")


_RESULT = "digest binary, least bigint, size bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept_sha256 string"


def _results(texts: DataFrame) -> DataFrame:
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, lists, digests = [], [], [], []
            for packed, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                raw = unpack.decompress(packed)
                pairs = np.frombuffer(spans or b"", dtype="<u4").reshape(-1, 2).tolist()
                kept, at = hashlib.sha256(), 0
                for begin, end in pairs:
                    kept.update(raw[at:begin])
                    at = end
                kept.update(raw[at:])
                sizes.append(len(raw))
                removed.append(sum(e - b for b, e in pairs))
                lists.append([{"begin": b, "end": e} for b, e in pairs])
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(lists, kind), pa.array(digests)],
                names=["digest", "least", "size", "n_removed", "spans", "kept_sha256"],
            )

    return texts.select("digest", F.col("doc_id").alias("least"), "packed", "spans").mapInArrow(run, _RESULT)


def find_repeats(docs: DataFrame, *, match: int = MATCH, anchor: int = ANCHOR, group: int = GROUP_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, spans, kept_sha256``.

    A byte of a whole text (UTF-8; null: empty) is removed if a string of
    ``match`` bytes that covers it also starts in a document with a smaller
    ``doc_id``; ``spans`` are the maximal removed runs ``[begin, end)``. Rows with
    one id are one document, a null id is the smallest.

    1. Equal texts form a class under its smallest id; in other rows of the class
       everything is removed. Classes lie in a table bucketed by their digest.
    2. Each string of ``match`` bytes has an anchor, its substring of ``anchor``
       bytes with the least hash. Anchors meet by hash, and those that lie in one
       class only are dropped: no string around them repeats elsewhere.
    3. The spans around the others go to the shard of their anchor, equal spans
       once with their least owner. A shard puts all suffixes of its different
       spans in order by external induced sorting; neighbours that share
       ``match`` bytes are one string, and its least owner decides. An anchor
       whose different spans may exceed ``group`` bytes is split: its strings
       go to shards by their own hash, where their least owner decides.
    4. Spans to remove go back to their class and are merged.
    """
    if not 1 <= anchor <= match:
        raise ValueError("an anchor lies within a match")
    spark = docs.sparkSession
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST_ID))
    rows = docs.select(own.alias("doc_id"), text_of(docs).alias("text"))
    digests = stage(docs.select(F.col("doc_id"), own.alias("own"), F.unhex(F.md5(F.encode(text_of(docs), "UTF-8"))).alias("digest")), "digests")
    name = _table(spark, rows)
    texts = spark.table(name)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SHARD_BYTES))
    keys = texts.select("cls", "digest")
    shared = stage(_shared_anchors(texts, buckets, match, anchor, group).join(keys, "cls").select("digest", "anchors", "hot"), "shared")
    pieces = _pieces(texts.join(shared, "digest"), buckets, match, anchor)
    removed = stage(_removed(pieces, match).join(keys, "cls").select("digest", "spans"), "removed")
    results = stage(_results(texts.join(removed, "digest", "left")), "results")
    spark.sql(f"DROP TABLE IF EXISTS {name}")

    copy = (F.col("own") > F.col("least")) & (F.col("size") >= match)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("size").alias("end")))
    return digests.join(results, "digest").select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.when(copy, F.col("size")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
