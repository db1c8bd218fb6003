"""Importance resampling against a plain version and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pyarrow as pa
import pytest

from hearth.llm import queries, resampling

SF = "/root/testdata/sf0.01"
EXTRA = "doc_id bigint, text string, weight string, rank int, s int, _down string"
ODD = [
    None, "", " ", "...", "a", "A a", "É é STRASSE Straße", "one two one two one", "x" * 3000, "ab " * 500, "a\nb\x00c\x7fd-e_f",
    "漢字 かな", "1 22 333", " lead and trail ", "the cat sat on the mat and the dog sat on the cat",
]


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def grams(text, order):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def buckets_of(text, order, buckets):
    return [zlib.crc32(gram.encode()) % buckets for gram in grams(text, order)]


def plain(rows, items, order, buckets, seed, least, percent):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets_of(text, order, buckets))
    for text in items:
        t.update(buckets_of(text, order, buckets))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        found = buckets_of(text, order, buckets)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(words_of(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    drawn = Counter()
    ranked = []
    for rank, row in enumerate(may, 1):
        ranked.append((*row, rank if rank <= percent * len(may) // 100 else None))
        drawn[row] += 1
    return Counter(ranked + [(*row, None) for row in out if row[1] < least])


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_features_in_any_blocks(order, size):
    found = [Counter() for _ in ODD]
    words = np.zeros(len(ODD), np.int64)
    for begin, end, block in resampling.features_of(pa.array(ODD), order, 997, size):
        for row, place in zip(block.rows, block.places, strict=True):
            found[begin + row][int(block.buckets[place])] += 1
        words[begin:end] += block.words
    assert found == [Counter(buckets_of(text, order, 997)) for text in ODD]
    assert words.tolist() == [len(words_of(text)) for text in ODD]


@pytest.mark.parametrize("order, least, percent", [(1, 1, 50), (2, 3, 30), (3, 0, 100), (1, 10**6, 10)])
def test_draws_equal_a_plain_version(spark, order, least, percent):
    rng = random.Random(order)
    vocabulary = ["w%d" % i for i in range(200)] + ["É", "the", "a"]
    texts = ODD + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(150)]
    rows = [(i * 7 % 331, text) for i, text in enumerate(texts)] + [(None, texts[-1]), (None, None), (5, texts[20]), (5, texts[20]), (5, texts[21])]
    items = [None, "", "the a w1 w2 w3", " ".join(vocabulary[:30])]
    docs = spark.createDataFrame([(i, text, "x", 1, 2, "y") for i, text in rows], EXTRA).repartition(5)
    target = spark.createDataFrame([(i, text) for i, text in enumerate(items)], "item_id int, text string")
    found = resampling.resample(docs, target, order=order, buckets=101, seed=7, least_words=least, percent=percent)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain(rows, items, order, 101, 7, least, percent)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string"), spark.createDataFrame([], EXTRA)
    assert resampling.resample(none, docs).count() == 0
    found = resampling.resample(docs, none, buckets=11, seed=2024, least_words=1, percent=100).collect()
    assert Counter(map(tuple, found)) == plain([(1, "a b"), (2, None)], [], 1, 11, 2024, 1, 100)


def test_query_equals_sql(spark):
    found = queries.QUERIES["op11_resampling"](spark, SF)
    assert oracle.difference(found, oracle.connect(SF), queries.SQL["op11_resampling"]) is None
