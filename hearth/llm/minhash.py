"""Near-duplicate documents: banded MinHash with sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of
from .components import components
from .wordhash import Words, blocks, byte_class, mix, texts_of, words_of

SHINGLE = 5
PERCENT = 85
ROWS = 6
# Chance that banding overlooks a pair just at the threshold, and that the
# posterior rules out such a pair.
MISS = 1e-6
BATCH = 30
# Members of a group that one task compares with one another or with as many others.
GROUP_BLOCK = 512
# Bytes of their sets in a block, and members of a large group that all others meet first.
BLOCK_WEIGHT = 16 << 20
PIVOTS = 8
# Blocks beyond which a group is large.
PIVOT_PARTS = 8
WORD_BYTES = byte_class(bytes([0x20, *range(0x09, 0x0E)]))


@dataclass(frozen=True)
class Plan:
    """Numbers that follow from the threshold (in per cent) and the chosen miss probability."""

    percent: int = PERCENT
    rows: int = ROWS
    miss: float = MISS
    batch: int = BATCH

    @property
    def bands(self) -> int:
        return max(1, math.ceil(math.log(self.miss) / math.log1p(-min((self.percent / 100) ** self.rows, 1 - 1e-9))))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def least_matches(self) -> list[tuple[int, int]]:
        """(n, m): of the first n hashes at least m must agree, or else the posterior
        probability (uniform prior) of a similarity at the threshold is below ``miss``."""
        t, found = self.percent / 100, []
        for n in [*range(self.batch, self.hashes, self.batch), self.hashes]:
            m = 0
            while m < n and _upper_tail(m, n, t) < self.miss:
                m += 1
            found.append((n, m))
        return found


def _upper_tail(m: int, n: int, t: float) -> float:
    """P(S >= t) for S ~ Beta(m + 1, n - m + 1): the chance of at most m successes in n + 1 trials at t."""
    if t >= 1:
        return float(m == n)
    logs = [math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k) + k * math.log(t) + (n + 1 - k) * math.log1p(-t) for k in range(m + 1)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(x - top) for x in logs)


def shingle_sets(found: Words, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    hashes, whole = found.shingles(size)
    for d in range(len(found.first) - 1):
        low, high = int(found.first[d]), int(found.first[d + 1])
        if high - low >= size:
            own = hashes[low:high][whole[low:high]]
            yield np.unique(own)
        elif high > low:
            own = found.hashes[low:high]
            mixed = mix(own * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, high - low + 1, dtype=np.uint64))
            yield np.array([np.bitwise_xor.reduce(mix(mixed + np.uint64(high - low)))], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([np.bitwise_xor.reduce(mix(hashes)), np.add.reduce(mix(hashes + np.uint64(len(hashes))))]).tobytes()


class Signer:
    """Minima of multiplicative hashes of a set."""

    def __init__(self, plan: Plan) -> None:
        rng = np.random.default_rng(20240229)
        self.plan = plan
        self.a = rng.integers(0, 1 << 32, plan.hashes, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, plan.hashes, dtype=np.uint32)

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        x = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
        best = np.full(self.plan.hashes, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(x), 512):
            np.minimum(best, (x[at : at + 512, None] * self.a + self.b).min(axis=0), out=best)
        return best

    def bands(self, signature: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band, which holds the number of the band."""
        rows = signature.reshape(self.plan.bands, self.plan.rows).astype(np.uint64)
        key = np.arange(1, self.plan.bands + 1, dtype=np.uint64)
        for j in range(self.plan.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
        return key.view(np.int64)


def sketch(docs: DataFrame, plan: Plan, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, signature`` of each row; the last three null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(plan)
        for batch in batches:
            texts = texts_of(batch.column(1))
            n, digests, bands, signatures = [], [], [], []
            for begin, end in blocks(texts):
                for own in shingle_sets(words_of(texts[begin:end], WORD_BYTES), size):
                    n.append(len(own))
                    if not len(own):
                        digests.append(None), bands.append(None), signatures.append(None)
                        continue
                    signature = signer.sign(own)
                    digests.append(set_digest(own))
                    bands.append(signer.bands(signature))
                    signatures.append(signature.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands", "signature"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, signature binary"
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole runs of rows that are equal in the first ``keys`` columns, many runs to a table."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        last, cut = [rows.column(k)[-1] for k in range(keys)], len(rows) - 1
        while cut and all(rows.column(k)[cut - 1] == last[k] for k in range(keys)):
            cut -= 1
        if cut:
            yield rows.slice(0, cut).combine_chunks()
        rest = rows.slice(cut).combine_chunks()
    if rest is not None and len(rest):
        yield rest


def _partners(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each row the range of rows that it is compared with: those after it in its
    run, or, where a run has two sides, the second side for rows of the first."""
    group, left, right, side = (table.column(k).to_numpy() for k in range(4))
    n = len(group)
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    run = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], n)[run]
    low = np.arange(n) + 1
    crossed = left != right
    first_of_second = np.full(run[-1] + 1, n, dtype=np.int64)
    np.minimum.at(first_of_second, run[side == 1], np.flatnonzero(side == 1))
    low = np.where(crossed, np.minimum(first_of_second[run], end), low)
    return low, np.where(crossed & (side == 1), low, end)


def _pair_chunks(low: np.ndarray, high: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (a, b) with low[a] <= b < high[a], in chunks."""
    count = np.maximum(high - low, 0)
    begin = 0
    while begin < len(count):
        end = max(begin + 1, begin + int(np.searchsorted(np.cumsum(count[begin:]), most, side="right")))
        n = count[begin:end]
        a = np.repeat(np.arange(begin, end), n)
        if len(a):
            yield a, low[a] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        begin = end


class _Forest:
    """Which rows of a table are joined already."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the pairs; returns those that are enough to join the same rows."""
        us, vs = [], []
        while True:
            la, lb = self.label[a], self.label[b]
            apart = np.flatnonzero(la != lb)
            if not len(apart):
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            high, at = np.unique(np.maximum(la, lb), return_index=True)
            us.append(a[at])
            vs.append(b[at])
            to = np.arange(len(self.label))
            to[high] = np.minimum(la, lb)[at]
            while (to[to] != to).any():
                to = to[to]
            self.label = to[self.label]
        return np.concatenate([*us, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*vs, np.zeros(0, np.int64)]).astype(np.int64)


def _survivors(signatures: np.ndarray, a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the posterior does not rule out, batch of hashes after batch."""
    matches, begin = np.zeros(len(a), dtype=np.int32), 0
    for n, least in steps:
        matches += (signatures[a, begin:n] == signatures[b, begin:n]).sum(axis=1, dtype=np.int32)
        kept = matches >= least
        a, b, matches, begin = a[kept], b[kept], matches[kept], n
        if not len(a):
            break
    return a, b


def _parts(n: Column, weight: Column, block: int) -> Column:
    """Blocks that so many members of that weight make; one at least, if there is a member."""
    return F.greatest(F.ceil(n / block), F.ceil(weight / BLOCK_WEIGHT)).cast("int")


def _attached(rows: DataFrame, payload: DataFrame) -> DataFrame:
    """Dealt rows with the payload of their class, each pair of blocks in one run."""
    return (
        stage(rows, "dealt").join(payload.hint("merge"), "cls")
        .select("grp", "left", "right", "side", "cls", *[c for c in payload.columns if c != "cls"])
        .repartition("grp", "left", "right")
        .sortWithinPartitions("grp", "left", "right", "side")
    )


def _all_pairs(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of each group in blocks, and every pair of blocks."""
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    dealt = members.join(sizes.select("grp", "parts").hint("merge"), "grp").withColumn("own", own)
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "grp",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "cls",
    )


def _against_pivots(members: DataFrame, popularity: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of large groups in blocks, each block beside the group's pivots: of each of
    ``PIVOTS`` parts the member that stands in the largest and most groups, a likely centre."""
    large = sizes.filter(F.col("parts") > PIVOT_PARTS)
    own = stage(members.join(large.select("grp", "parts").hint("merge"), "grp").join(popularity.hint("merge"), "cls"), "large")
    # one of each of so many parts of a group, found map-side: a window would gather the group
    part = F.pmod(F.xxhash64("cls"), F.lit(PIVOTS))
    pivots = own.groupBy("grp", "parts", part.alias("part")).agg(F.max_by("cls", "popularity").alias("cls"))
    beside = pivots.select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("left"), F.lit(-1).alias("right"), F.lit(1).alias("side"), "cls")
    return own.select(
        "grp", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("left"), F.lit(-1).alias("right"), F.lit(0).alias("side"), "cls"
    ).unionByName(beside)


def _apart(members: DataFrame, joined: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Members in blocks, and every pair of blocks that may hold members not joined yet.

    ``joined`` (``node, component``) says which classes are joined already. In each group
    the members of its greatest component are compared with all others, and the others
    with one another; the members of that component need no comparison among themselves.
    """
    labelled = stage(
        members.join(joined.select(F.col("node").alias("cls"), F.col("component").alias("label")).hint("merge"), "cls", "left"), "labelled"
    )
    counts = labelled.filter("label IS NOT NULL").groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    greatest = counts.groupBy("grp").agg(F.max(F.struct("n", "label", "w")).alias("top"))
    top_n, top_w = F.coalesce("top.n", F.lit(0)), F.coalesce("top.w", F.lit(0))
    plan = stage(
        sizes.join(greatest.hint("merge"), "grp", "left").select(
            "grp",
            F.col("top.label").alias("top_label"),
            _parts(F.col("n") - top_n, F.col("w") - top_w, block).alias("others"),
            _parts(top_n, top_w, block).alias("tops"),
        ).filter("others > 0"),
        "blocks",
    )
    dealt = labelled.join(plan.hint("merge"), "grp").withColumn("in_top", F.coalesce(F.col("label") == F.col("top_label"), F.lit(False)))
    parts = F.when(F.col("in_top"), F.col("tops")).otherwise(F.col("others"))
    own = F.pmod(F.xxhash64("cls"), parts).cast("int")
    # blocks of the greatest component are numbered -1, -2, ... and meet blocks of others only
    others = F.sequence(F.lit(0), F.col("others") - 1)
    tops = F.when(F.col("tops") > 0, F.transform(F.sequence(F.lit(1), F.col("tops")), lambda i: -i)).otherwise(F.array().cast("array<int>"))
    met = F.explode(F.when(F.col("in_top"), others).otherwise(F.concat(others, tops)))
    rows = dealt.withColumn("own", F.when(F.col("in_top"), -1 - own).otherwise(own)).withColumn("other", met)
    return rows.select(
        "grp",
        F.greatest("own", "other").alias("left"),
        F.least("own", "other").alias("right"),
        (F.col("own") < F.col("other")).cast("int").alias("side"),
        "cls",
    )


def group_links(members: DataFrame, popularity: DataFrame, payload: DataFrame, compare, block: int) -> DataFrame:
    """``u, v``: links that join the same classes as all links within groups.

    ``members`` is ``grp, cls, weight``; ``popularity`` and ``payload`` (both by ``cls``) are
    attached to the rows that need them. Members of a group of more than ``PIVOT_PARTS``
    blocks are first compared with a few pivots; then only pairs that these links did not
    join are dealt. So a group of near copies around a centre costs its size, and not its
    square; in smaller groups a member is dealt ``PIVOT_PARTS`` times at most.
    """
    sizes = stage(
        members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).filter("n > 1")
        .withColumn("parts", _parts(F.col("n"), F.col("w"), block)),
        "group-sizes",
    )
    if sizes.filter(F.col("parts") > PIVOT_PARTS).isEmpty():
        return _links(_attached(_all_pairs(members, sizes), payload), compare)
    first = stage(_links(_attached(_against_pivots(members, popularity, sizes), payload), compare), "pivot-links")
    joined = stage(components(first), "joined")
    rest = _links(_attached(_apart(members, joined, sizes, block), payload), compare)
    return rest.unionByName(first).distinct()


def _links(dealt: DataFrame, compare) -> DataFrame:
    """``u, v``: per block, links that join the same classes as all links it finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 3):
            ids = table.column("cls").to_numpy()
            found = list(compare(table, *_partners(table)))
            us = np.concatenate([ids[a] for a, _ in found] or [np.zeros(0, np.int64)])
            vs = np.concatenate([ids[b] for _, b in found] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype="<u2").reshape(len(table), -1)


def _alike(steps: list[tuple[int, int]]):
    """Links of pairs that the posterior does not rule out."""

    def compare(table: pa.Table, low: np.ndarray, high: np.ndarray):
        signatures, forest = _signatures(table), _Forest(len(table))
        for a, b in _pair_chunks(low, high):
            yield forest.add(*_survivors(signatures, a, b, steps))

    return compare


def _verified(steps: list[tuple[int, int]], percent: int):
    """Links of pairs that also reach the threshold on the full sets."""

    def linked(p: np.ndarray, q: np.ndarray) -> bool:
        if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
            return False
        both = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * both >= percent * (len(p) + len(q) - both)

    def compare(table: pa.Table, low: np.ndarray, high: np.ndarray):
        signatures, forest = _signatures(table), _Forest(len(table))
        sets = [np.frombuffer(s, dtype="<u8") for s in table.column("shingles").to_pylist()]
        for a, b in _pair_chunks(low, high, most=4000):
            a, b = _survivors(signatures, a, b, steps)
            apart = forest.label[a] != forest.label[b]
            a, b = a[apart], b[apart]
            true = np.array([linked(sets[x], sets[y]) for x, y in zip(a, b, strict=True)], dtype=bool)
            yield forest.add(a[true], b[true])

    return compare


def near_duplicates(
    docs: DataFrame, *, percent: int = PERCENT, shingle: int = SHINGLE, miss: float = MISS, block: int = GROUP_BLOCK
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets of ``shingle``-word shingles have ``100 * intersection >=
    percent * union`` are linked; a component has the smallest id that links
    reach, and its document of that id is kept. Texts without words have an empty
    set and no link.

    Equal sets form a class with one representative, so exact copies cost no
    comparison. Representatives that share a band are compared by their
    signatures in batches; a pair is dropped as soon as the posterior says that
    it reaches the threshold with less than ``miss`` probability. What survives
    forms clusters; in these, surviving pairs are verified on the full sets.
    Members of a large band or cluster first meet a few pivots; then every pair that
    these links have not joined is compared, in blocks of about ``block`` members and
    of bounded size, and a block returns only links enough to join the same documents.
    Banding and pruning may each overlook a pair with about ``miss`` probability;
    no link is reported wrongly. ``doc_id`` is an integer. Repeated rows of one id are judged by their own
    texts. A row with a null id is its own component, named null, and kept.
    """
    plan = Plan(percent=percent, miss=miss)
    steps = plan.least_matches()
    sketches = stage(sketch(docs, plan, shingle), "sketches")
    known = sketches.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = stage(known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "classes")
    reps = stage(
        known.join(classes, ["digest", "doc_id"]).dropDuplicates(["digest"])
        .select("digest", "doc_id", "bands", "signature").withColumn("cls", F.monotonically_increasing_id()),
        "representatives",
    )

    banded = reps.select(F.explode("bands").alias("band"), "cls")
    shared = stage(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bands")
    members = stage(banded.join(shared.hint("merge"), "band").select("band", "cls", "n"), "members")
    popularity = members.groupBy("cls").agg(F.sum("n").alias("popularity"))
    in_bands = members.select(F.col("band").alias("grp"), "cls", F.lit(1).alias("weight"))
    similar = group_links(in_bands, popularity, reps.select("cls", "signature"), _alike(steps), block)
    clusters = stage(components(similar), "clusters")

    wanted = clusters.join(reps, clusters["node"] == reps["cls"]).select("cls", "digest", "doc_id")
    texts = docs.select(F.col("doc_id").cast("bigint"), text_of(docs).alias("text")).join(stage(wanted, "wanted").hint("merge"), "doc_id")
    full = stage(_with_sets(texts, plan, shingle).dropDuplicates(["cls"]), "sets")
    clustered = clusters.select(F.col("node").alias("cls"), F.col("component").alias("grp")).join(full.select("cls", "weight").hint("merge"), "cls")
    links = group_links(stage(clustered, "clustered"), popularity, full.drop("weight"), _verified(steps, percent), block)
    found = stage(components(links), "components")

    numbered = reps.select("cls", "digest", "doc_id").join(found, F.col("cls") == F.col("node"), "left").select(
        "digest", "doc_id", F.coalesce("component", "cls").alias("component")
    )
    names = numbered.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stage(stage(numbered, "numbered").join(stage(names, "names"), "component").select("digest", "component_id"), "named")
    return (
        sketches.join(named, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def _with_sets(rows: DataFrame, plan: Plan, size: int) -> DataFrame:
    """``cls, signature, shingles, weight`` (bytes of shingles) from rows whose text has the digest of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(plan)
        for batch in batches:
            texts, digests = texts_of(batch.column(2)), batch.column(1).to_pylist()
            at, signatures, sets = [], [], []
            for begin, end in blocks(texts):
                for i, own in enumerate(shingle_sets(words_of(texts[begin:end], WORD_BYTES), size), begin):
                    if len(own) and set_digest(own) == digests[i]:
                        at.append(i)
                        signatures.append(signer.sign(own).astype("<u2").tobytes())
                        sets.append(own.astype("<u8").tobytes())
            chosen = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen, pa.array(signatures, pa.binary()), pa.array(sets, pa.binary()), pa.array([len(s) for s in sets], pa.int64())],
                names=["cls", "signature", "shingles", "weight"],
            )

    return rows.select("cls", "digest", "text").mapInArrow(run, "cls bigint, signature binary, shingles binary, weight bigint")
