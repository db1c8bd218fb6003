"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bound_batches
from .common import text_of
from .features import Characters, held_out, sampled, text_blocks, vector_sum

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BITS = 16
# The classifier is fitted on about this many documents, dealt evenly over languages.
MAX_TRAINING_DOCS = 4000
FOLDS = (5, 0)
EPOCHS = 4
# An n-gram is known if it occurs in this part of the fitted documents of any language.
KNOWN_IN = 0.01
# A text is strange if its share of known n-grams is below this part of what all but
# 5% of the documents kept from fitting have in a language that it may be in.
KNOWN_PART = 0.9
POSSIBLE = 0.05
# Texts of fewer different n-grams are too short to tell.
LEAST_NGRAMS = 100
# Rows of an Arrow batch that are judged, and handed on, at a time.
PART_ROWS = 1000
_ASCII_LETTER = re.compile(r"[A-Za-z]")

# Digits, marks and control characters count as blanks, letters as lower case.
_FOLD = np.full(128, 32, dtype=np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def _buckets(part: list[str]) -> tuple[Characters, list[tuple[np.ndarray, np.ndarray]]]:
    chars = Characters.of([t.lower() for t in part], _FOLD)
    return chars, [chars.ngrams(order, BITS) for order in ORDERS]


def _present(batch: pa.RecordBatch) -> np.ndarray:
    """In how many texts each bucket occurs; the last place counts the texts."""
    counts = np.zeros((1 << BITS) + 1, dtype=np.int64)
    seen = np.zeros(1 << BITS, dtype=bool)
    texts = batch.column(0).to_pylist()
    for _, part in text_blocks(texts):
        chars, orders = _buckets(part)
        for d in range(len(part)):
            low, high = chars.begin[d], chars.begin[d + 1]
            for bucket, whole in orders:
                seen[bucket[low:high][whole[low:high]]] = True
            counts[:-1] += seen
            seen[:] = False
    counts[-1] = len(texts)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # weight times inverse document frequency, a row for each language
    bias: np.ndarray
    temperature: float = 1.0
    known: np.ndarray | None = None  # which n-grams are known
    usual: np.ndarray | None = None  # a low share of known n-grams for each language

    def strange(self, texts: list[str | None]) -> np.ndarray:
        """Whether a text has too few known n-grams for any language it may be in, however many were learned.

        The languages count together as known, so a text of several is not strange.
        """
        out = np.zeros(len(texts), dtype=bool)
        if self.known is None or self.known.all():
            return out
        able = [i for i, t in enumerate(texts) if t and has_letter(t)]
        few, shares = [], []
        for at, part in text_blocks([texts[i] for i in able]):
            chars, orders = _buckets(part)
            n, held = np.zeros(len(part)), np.zeros(len(part))
            for bucket, whole in orders:
                n += chars.per_text(whole.astype(np.int64))
                held += chars.per_text((whole & self.known[bucket]).astype(np.int64))
            share = _beyond_chance(held / np.maximum(n, 1), self.known)
            for d in np.flatnonzero(share < KNOWN_PART * self.usual.max()):
                low, high = chars.begin[d], chars.begin[d + 1]
                if len(np.unique(np.concatenate([b[low:high][w[low:high]] for b, w in orders]))) >= LEAST_NGRAMS:
                    few.append(able[at + d])
                    shares.append(share[d])
        if few:
            p = softmax(self.logits([texts[i] for i in few]) / self.temperature)
            possible = p >= min(POSSIBLE, 1 / len(self.languages))
            out[few] = np.array(shares) < KNOWN_PART * np.where(possible, self.usual, np.inf).min(axis=1)
        return out

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for at, part in text_blocks(texts):
            chars, orders = _buckets(part)
            n = np.zeros(len(part))
            for bucket, whole in orders:
                n += chars.per_text(whole.astype(np.int64))
                for k, weights in enumerate(self.table):
                    out[at : at + len(part), k] += chars.per_text(np.where(whole, weights[bucket], 0.0))
            out[at : at + len(part)] /= np.maximum(n, 1)[:, None]
        return out + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability; ``und`` and 0 where there is no letter."""
        found = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        if known:
            p = softmax(self.logits([texts[i] for i in known]) / self.temperature)
            best = p.argmax(axis=1)
            scores[known] = p[np.arange(len(known)), best]
            for i, k in zip(known, best, strict=True):
                found[i] = self.languages[k]
        return found, scores


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _beyond_chance(share, known: np.ndarray):
    """A share of known n-grams without those that only share a bucket with a known one."""
    chance = known.mean()
    return np.maximum(0.0, (share - chance) / (1 - chance))


def _familiar(learned: list, kept: list, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Known n-grams of the learned examples, and for each language a low share of them in kept examples (none: 0)."""
    size = 1 << BITS
    known, usual = np.zeros(size, dtype=bool), np.zeros(languages)
    for k in range(languages):
        own = [at[:-1] for at, _, label in learned if label == k]
        counts = np.bincount(np.concatenate([*own, np.zeros(0, dtype=np.int64)]), minlength=size)
        known |= counts >= max(1, KNOWN_IN * len(own))
    if not known.all():
        for k in range(languages):
            shares = [tf[known[at[:-1]]].sum() for at, tf, label in kept if label == k and len(tf) >= LEAST_NGRAMS]
            if shares:
                usual[k] = _beyond_chance(np.quantile(shares, 0.05), known)
    return known, usual


class Ftrl:
    """Follow the regularised leader, with L1 and L2 penalties; a row of weights for each class."""

    def __init__(self, classes: int, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((classes, size)), np.zeros((classes, size))

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[:, at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax((w @ x)[None])[0]
        error[label] -= 1
        g = error[:, None] * x
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def _calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss."""
    grid = np.geomspace(0.05, 20, 121)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(rows: DataFrame, *, max_docs: int = MAX_TRAINING_DOCS, epochs: int = EPOCHS) -> LanguageModel:
    """Fit on rows ``(doc_id, text, lang)``.

    Document frequencies cover all rows with a language and a text. The
    regression is fitted on about ``max_docs`` of them, chosen by a hash of
    ``doc_id`` so that each language gets an equal share at most; every fifth is
    kept for the temperature.
    """
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((0, 1 << BITS)), np.zeros(0))
    present = vector_sum(rows.select("text"), _present, (1 << BITS) + 1)
    idf = np.log((1 + present[-1]) / (1 + present[:-1])) + 1

    share = max(1, max_docs // len(languages))
    portion = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, share / counts[name]))])
    sample = rows.filter(sampled("doc_id", F.element_at(portion, F.col("lang"))))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1).to_pylist(), []
            for _, part in text_blocks(texts):
                chars, orders = _buckets(part)
                for d in range(len(part)):
                    low, high = chars.begin[d], chars.begin[d + 1]
                    every = np.concatenate([b[low:high][w[low:high]] for b, w in orders])
                    bucket, n = np.unique(every, return_counts=True)
                    found.append((bucket.astype("<i4").tobytes(), (n / max(1, len(every))).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())],
                names=["lang", "bucket", "tf"],
            )

    examples = sample.select("lang", "text").mapInArrow(extract, "lang string, bucket binary, tf binary").collect()
    number = {name: k for k, name in enumerate(languages)}
    size = 1 << BITS
    data = []
    for lang, bucket, tf in sorted(examples):
        at = np.frombuffer(bucket, dtype="<i4")
        x = np.frombuffer(tf, dtype="<f4") * idf[at]
        data.append((np.append(at, size), np.append(x, 0.1), number[lang]))
    order = np.random.default_rng(7).permutation(len(data))
    kept = [data[i] for i in order[: len(data) // 5]]
    learned = [data[i] for i in order[len(data) // 5 :]]
    model = Ftrl(len(languages), size + 1)
    for _ in range(epochs):
        for at, x, label in learned:
            model.learn(at, x, label)
    w = model.weights()
    found = LanguageModel(languages, (w[:, :-1] * idf).astype(np.float32), w[:, -1] * 0.1)
    if kept:
        found.known, found.usual = _familiar(learned, [(at, x[:-1] / idf[at[:-1]], label) for at, x, label in kept], len(languages))
        logits = np.array([w[:, at] @ x for at, x, _ in kept])
        found.temperature = _calibrate(logits, np.array([label for *_, label in kept]))
    return found


def identify(docs: DataFrame, model: LanguageModel, *, familiar: bool = False) -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score`` of each whole text; ``text`` stays as it is.

    With ``familiar``, rows whose text is strange to the model are left out.
    """
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    kept = docs.select(*[f"`{c}`" for c in names])
    place = [c.lower() for c in names].index("text")

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(place).cast(pa.string()).to_pylist()
        if familiar:
            keep = ~model.strange(texts)
            batch, texts = batch.filter(pa.array(keep)), [t for t, k in zip(texts, keep, strict=True) if k]
        found, scores = model.predict(texts)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PART_ROWS):
                yield judged(batch.slice(begin, PART_ROWS))

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def predict_languages(docs: DataFrame, *, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs``.

    The model learns from text and language of the documents that are not held
    out; id, language and source never enter a prediction. A text that is null or
    has no letter is ``und`` with score 0, as is every text if nothing could be learned.
    """
    out = held_out(docs, *FOLDS)
    model = train(docs.filter(~out).select("doc_id", "text", F.col("lang").cast("string").alias("lang")), max_docs=max_docs)
    rows = docs.select("doc_id", out.alias("held_out"), text_of(docs).alias("text"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
