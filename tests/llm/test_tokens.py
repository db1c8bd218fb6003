"""Token counts and packing against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hearth.llm import bpe, packing, queries, token_counts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a\n", "\na", "a  b", "a\n\nb", "a \nb", "a\n b", "tab\there", "nbsp x",
    "x y", "x​y", "line sep", "it's we'll don't 'quote' ''s", "1234 56,789.0", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|>", "é ü ñ ß 漢字 かな \U0001f600 \U0001f1e9\U0001f1ea", "\x00 \x1c \x85", "a᠎b c",
    "é combining", "x" * 5000, "word " * 3000, "A-B_C d.e,f;g!h?", "ı İ ſ K", "١٢٣ ½ ²",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def odd_texts():
    pieces = ["a", "Bc", "é", "'s", "12", "...", " ", "  ", "\n", "\t", "漢", "<|endoftext|>", "\u2003", "!", "\x01", "\x1d", " a", "\nb"]
    rng = random.Random(1)
    return [t or "" for t in ODD] + ["".join(rng.choices(pieces, k=rng.randint(1, 30))) for _ in range(3000)]


def listed(ids, counts):
    return [one.tolist() for one in np.split(ids, np.cumsum(counts)[:-1])]


def test_encoder_equals_library(tokenizer):
    texts, one = odd_texts(), bpe.Encoder(PATH)
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):  # the second time with known units
        assert listed(*one.encode(pa.array(texts))) == expected
        assert one.count(pa.array(texts)).tolist() == [len(ids) for ids in expected]


def test_known_units_are_bounded(tokenizer):
    texts, one = odd_texts(), bpe.Encoder(PATH, cache_bytes=4000)
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        assert listed(*one.encode(pa.array(some))) == [tokenizer.encode(text).ids for text in some]
        assert one._known.nbytes() < 6000


@pytest.mark.parametrize("size", [1, 5, 60, 1 << 20])
def test_long_texts_in_parts(tokenizer, size):
    """Parts of a long text have its ids, wherever it is cut."""
    texts, one, found, begun = odd_texts()[:400], bpe.Encoder(PATH), [], []
    for block, rows in bpe.in_blocks(pa.array([*texts, None], pa.string()), size):
        ids = listed(*one.encode(block))
        begun += ids[0]
        if rows:
            found += [begun, *ids[1:]]
            begun = []
    assert found == [tokenizer.encode(text).ids for text in [*texts, ""]]


def frame(spark, texts):
    rows = [(i, t, "clash", i) for i, t in enumerate(texts)] + [(0, texts[0], "repeat", 0), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, offset int")


def test_counts(spark, folder, tokenizer):
    docs = frame(spark, ODD)
    expected = sorted(
        (str(r.doc_id), len((r.text or "").encode()), n := len(tokenizer.encode(r.text or "").ids), n > 1024) for r in docs.collect()
    )
    for _ in range(2):  # the second time from the cache
        rows = token_counts.count_tokens(docs, PATH, folder)
        assert sorted((str(r[0]), *r[1:]) for r in rows.collect()) == expected
    stored = spark.read.parquet(folder)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for t in ODD}) + 1


def test_cache_is_used_and_versioned(spark, folder):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    version = token_counts.tokenizer_version(PATH)
    import hashlib

    digest = bytearray(hashlib.sha256(b"some words").digest())
    other = [(digest, version, 77), (digest, "another", 5)]
    spark.createDataFrame(other, token_counts.CACHE_SCHEMA).write.parquet(folder)
    assert token_counts.count_tokens(docs, PATH, folder).collect()[0].n_tokens == 77


def test_counts_of_nothing(spark, folder):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    rows = token_counts.count_tokens(docs, PATH, folder)
    assert rows.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and rows.count() == 0


def check_packing(rows, expected, capacity, tokenizer):
    """Every id lies in one piece, pieces match their checksums, sequences have no gaps."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert docs.keys() == expected.keys()
    for doc_id, texts in expected.items():
        ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for t in texts]
        assert {r.doc_tokens for r in docs[doc_id]} == {len(i) for i in ids}
        at = 0
        for r in sorted(docs[doc_id], key=lambda r: r.start):
            if len(ids) == 1:
                assert r.start == at
                at += r.length
            assert any(zlib.crc32(i[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for i in ids)
        assert sum(r.length for r in docs[doc_id]) == sum(map(len, ids))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("capacity, fan_in", [(1024, 16), (16, 2), (1, 2), (7, 2)])
def test_packing_of_odd_texts(spark, tokenizer, capacity, fan_in):
    docs = frame(spark, [t for t in ODD if len(t or "") < 1000]).repartition(7)
    expected = defaultdict(list)
    for r in docs.collect():
        expected[r.doc_id].append(r.text)
    rows = packing.pack(docs, PATH, capacity=capacity, fan_in=fan_in, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    check_packing(rows, expected, capacity, tokenizer)


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(docs, PATH).count() == 0


def test_queries(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {r.doc_id: [r.text] for r in docs}
    rows = queries.QUERIES["op2_packing"](spark, SF).collect()
    tokens = sum(r.length for r in rows)
    assert check_packing(rows, expected, 1024, tokenizer) < 0.02 * tokens
    counts = {r.doc_id: r.n_tokens for r in queries.QUERIES["op10_token_counts"](spark, SF).collect()}
    assert counts == {k: len(tokenizer.encode(t[0]).ids) for k, t in expected.items()}
