"""Quality scores from supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .features import Characters, held_out, sampled, text_blocks

ORDERS = (2, 3, 4)
BITS = 16
# Behind the hashed buckets: another word follows, or the same one again.
SIZE = (1 << BITS) + 2
# Stands before the first word of a text.
START = 1 << BITS
DIMENSIONS = 16
EPOCHS = 5
RATE = 0.5
# The classifier is fitted on about this many labelled documents.
MAX_TRAINING_DOCS = 4000
FOLDS = (4, 2)
THRESHOLD = 0.7


def _words(chars: Characters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its bucket, that of its pair with the word before it (or the text's
    start), that of whether both are the same, and its place."""
    words, places = chars.words(BITS)
    before = np.concatenate([[START], words[:-1]])[: len(words)].astype(np.uint64)
    first = np.searchsorted(places, chars.begin[:-1])
    before[first[first < len(words)]] = START
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    pairs = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)
    return words, pairs.astype(np.int32), (1 << BITS) + (before == words).astype(np.int32), places


@dataclass
class QualityModel:
    """Label 1 against label 0. As the output is linear in the averaged vectors, each
    bucket's vector and the output weights come down to one number for scoring."""

    table: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for at, part in text_blocks(texts):
            chars = Characters.of(part)
            words, pairs, again, places = _words(chars)
            total = chars.per_text(self.table[words] + self.table[pairs] + self.table[again], places)
            n = chars.per_text(np.full(len(places), 3.0), places)
            for order in ORDERS:
                bucket, whole = chars.ngrams(order, BITS)
                total += chars.per_text(np.where(whole, self.table[bucket], 0.0))
                n += chars.per_text(whole.astype(np.int64))
            out[at : at + len(part)] = total / np.maximum(n, 1)
        return 1 / (1 + np.exp(-(out + self.bias)))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], *, dimensions: int = DIMENSIONS, epochs: int = EPOCHS) -> QualityModel:
    """Stochastic gradient descent over ``(buckets, shares, label)``, one document a step.

    The step of a vector is divided by the root of the squares of its steps so
    far (and an output weight's likewise), so that rare and common n-grams move
    at their own pace.
    """
    if not examples:
        return QualityModel(np.zeros(SIZE, dtype=np.float32), 0.0)
    rng = np.random.default_rng(11)
    vectors = rng.uniform(-1, 1, (SIZE, dimensions)).astype(np.float32) / dimensions
    output, bias = rng.normal(0, 0.5, (dimensions, 2)).astype(np.float32), np.zeros(2)
    seen_v, seen_o = np.full(SIZE, 1e-8, dtype=np.float32), np.full((dimensions, 2), 1e-2, dtype=np.float32)
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for i in rng.permutation(len(examples)):
            at, share, label = examples[i]
            own = vectors[at]
            mean = share @ own
            error = _softmax(mean @ output + bias)
            error[label] -= 1
            g_mean = output @ error
            g_output = np.outer(mean, error)
            seen_v[at] += share * share * float(g_mean @ g_mean)
            vectors[at] = own - (rate * 0.2 * share / np.sqrt(seen_v[at]))[:, None] * g_mean
            seen_o += g_output * g_output
            output -= rate * 0.2 * g_output / np.sqrt(seen_o)
            bias -= rate * 0.1 * error
    weight = output[:, 1] - output[:, 0]
    return QualityModel((vectors @ weight).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, *, max_docs: int = MAX_TRAINING_DOCS, epochs: int = EPOCHS) -> QualityModel:
    """Fit on about ``max_docs`` rows of ``labels`` (chosen by a hash of ``doc_id``) with their texts.

    A label is 0 or 1; other values and nulls teach nothing, and of several labels
    of one document the smallest counts.
    """
    rows = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    n = rows.count()
    chosen = rows.filter(sampled("doc_id", min(1.0, max_docs / n) if n else 1.0))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, part in text_blocks([t or "" for t in batch.column(1).to_pylist()]):
                chars = Characters.of(part)
                words, pairs, again, places = _words(chars)
                bound = np.searchsorted(places, chars.begin)
                grams = [chars.ngrams(order, BITS) for order in ORDERS]
                for d in range(len(part)):
                    low, high = chars.begin[d], chars.begin[d + 1]
                    own = slice(bound[d], bound[d + 1])
                    every = [words[own], pairs[own], again[own], *(b[low:high][w[low:high]] for b, w in grams)]
                    bucket, count = np.unique(np.concatenate(every), return_counts=True)
                    share = count / max(1, count.sum())
                    found.append((bucket.astype("<i4").tobytes(), share.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())],
                names=["quality", "bucket", "share"],
            )

    # the chosen labels are about max_docs rows of two numbers, so they go to every task
    examples = (
        docs.select("doc_id", text_of(docs).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("quality", "text")
        .mapInArrow(extract, "quality int, bucket binary, share binary")
        .collect()
    )
    parsed = [(np.frombuffer(b, dtype="<i4"), np.frombuffer(s, dtype="<f4"), q) for q, b, s in sorted(examples)]
    return fit(parsed, epochs=epochs)


def score_quality(
    docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, max_docs: int = MAX_TRAINING_DOCS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Only labels of documents that are not held out are learned; a score depends
    on the text alone. Null and empty texts get the score of the empty text;
    without any label all scores are 0.5.
    """
    model = train(docs, labels.filter(~held_out(labels, *FOLDS)), max_docs=max_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(batch.column(2).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(docs, *FOLDS).alias("held_out"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
