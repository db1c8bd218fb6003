"""Batched scoring of texts against a plain computation, text by text and n-gram by n-gram."""

import math
import random

import numpy as np
import pytest

from hearth.llm import features, language, quality

TEXTS = [
    "", " ", "a", "ab", "a b", "one one two  two\ttwo\nend", "É été Straße İstanbul", "漢字 かな 漢字", "x" * 500, "12 34, a-b!", "\x00\x1f tail ",
    "The the THE cat sat on the mat and the cat sat. " * 9, "\U0001f600 \U0001f600 ok", "word " * 300,
]
MASK = (1 << 32) - 1


def gram_bucket(codes, bits):
    total = len(codes) * 0x2545F491 & MASK
    for j, code in enumerate(codes):
        total ^= (code + j + 1) * int(features._MULTIPLIERS[j % len(features._MULTIPLIERS)]) & MASK
        total = total * 0x9E3779B1 & MASK
    total ^= total >> 15
    return (total * 0x85EBCA77 & MASK) >> (32 - bits)


def word_bucket(word, bits):
    wide, sums = (1 << 64) - 1, 0
    for k, char in enumerate(word):
        m = (ord(char) + 1) * ((0x9E3779B97F4A7C15 * (k + 1) & wide) | 1) & wide
        sums = sums + (m ^ (m >> 31)) & wide
    return ((sums ^ (sums >> 29)) * 0xBF58476D1CE4E5B9 & wide) >> (64 - bits)


def pair_bucket(before, word, bits):
    wide = (1 << 64) - 1
    mixed = (before * 0x9E3779B97F4A7C15 + word + 1) * 0xBF58476D1CE4E5B9 & wide
    return ((mixed ^ (mixed >> 31)) * 0x94D049BB133111EB & wide) >> (64 - bits)


def grams(codes, orders, bits):
    return [gram_bucket(codes[i : i + n], bits) for n in orders for i in range(len(codes) - n + 1)]


def quality_buckets(text):
    """Words, pairs with the word before, repetitions, and n-grams of the text and one blank."""
    words, word = [], ""
    for char in text + " ":
        if char in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += char
    found = [word_bucket(w, quality.BITS) for w in words]
    before = [quality.START, *found[:-1]]
    pairs = [pair_bucket(a, b, quality.BITS) for a, b in zip(before, found)]
    again = [(1 << quality.BITS) + (a == b) for a, b in zip(before, found)]
    return found + pairs + again + grams([ord(c) for c in text + " "], quality.ORDERS, quality.BITS)


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_scores(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    model = quality.QualityModel(rng.normal(0, 3, quality.SIZE).astype(np.float32), 0.3)
    texts = TEXTS + ["".join(random.Random(i).choices("ab c\né", k=i)) for i in range(60)]
    expected = []
    for text in texts:
        own = quality_buckets(text)
        mean = sum(float(model.table[b]) for b in own) / max(1, len(own))
        expected.append(1 / (1 + math.exp(-(mean + model.bias))))
    assert np.allclose(model.score(texts), expected, rtol=1e-5, atol=1e-7)
    monkeypatch.setattr(features, "BLOCK_CHARS", 40)  # many blocks
    assert np.allclose(model.score(texts), expected, rtol=1e-5, atol=1e-7)


def folded(text):
    out = []
    for char in text.lower() + " ":
        code = ord(char)
        out.append(code if code >= 128 else code if 97 <= code < 123 else 32)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_language_predictions(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    names = ["aa", "bb", "cc"]
    table = rng.normal(0, 5, (3, 1 << language.BITS)).astype(np.float32)
    model = language.LanguageModel(names, table, np.array([0.1, -0.2, 0.0]), temperature=1.7)
    texts = TEXTS + ["".join(random.Random(i).choices("AbC d\né1", k=i)) for i in range(60)]
    expected = []
    for text in texts:
        if not any(c.isalpha() for c in text):
            expected.append(("und", 0.0))
            continue
        own = grams(folded(text), language.ORDERS, language.BITS)
        logits = [sum(float(table[k][b]) for b in own) / max(1, len(own)) + model.bias[k] for k in range(3)]
        e = [math.exp((x - max(logits)) / 1.7) for x in logits]
        k = int(np.argmax(e))
        expected.append((names[k], e[k] / sum(e)))
    for size in (features.BLOCK_CHARS, 40):
        monkeypatch.setattr(features, "BLOCK_CHARS", size)
        found, scores = model.predict(texts)
        assert found == [name for name, _ in expected]
        assert np.allclose(scores, [score for _, score in expected], rtol=1e-5, atol=1e-7)
