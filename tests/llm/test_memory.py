"""What goes to a Python worker, and which passes write files."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_tokens import PATH

import corpus_pipeline
from hearth.llm import features, language, token_counts
from hearth.session import BATCH_BYTES, shared_dir

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def unbounded(spark):
    old = spark.conf.get(SETTING, None)
    spark.conf.unset(SETTING)
    yield spark
    spark.conf.unset(SETTING)
    if old is not None:
        spark.conf.set(SETTING, old)


def largest_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    return spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("t")).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def test_batches_of_token_counts_are_bounded(unbounded, folder):
    token_counts.count_tokens(unbounded.createDataFrame([(1, "some words")], "doc_id bigint, text string"), PATH, folder)
    assert largest_batch(unbounded) < BATCH_BYTES + 10_000


def test_a_bound_of_the_session_stays(unbounded, folder):
    unbounded.conf.set(SETTING, 1 << 20)
    token_counts.count_tokens(unbounded.createDataFrame([(1, "some words")], "doc_id bigint, text string"), PATH, folder)
    assert largest_batch(unbounded) < (1 << 20) + 10_000


def test_batches_of_language_training_are_bounded(unbounded):
    language.train(unbounded.createDataFrame([(1, "some words", "en")], "doc_id bigint, text string, lang string"))
    assert largest_batch(unbounded) < BATCH_BYTES + 10_000


@pytest.mark.parametrize("size", [1, features.PIECE, 2 * features.PIECE + 3])
@pytest.mark.parametrize(("rows", "partitions"), [(0, 1), (1, 1), (5000, 7), (300, 2 * features.SUM_TASKS)])
def test_sums_of_vectors_write_no_files(spark, size, rows, partitions):
    def local(batch):
        return np.bincount(batch.column(0).to_numpy() % size, minlength=size)

    def files():
        return {str(f) for f in Path(shared_dir(spark), "hearth").rglob("*")}

    before = files()
    found = features.vector_sum(spark.range(0, rows, 1, partitions), local, size)
    assert found.tolist() == np.bincount(np.arange(rows) % size, minlength=size).tolist()
    assert files() == before


def test_pipeline_sends_a_text_once(spark, monkeypatch):
    sent, real = [], language.identify
    monkeypatch.setattr(language, "identify", lambda docs, *a, **k: sent.append(docs.schema) or real(docs, *a, **k))
    docs = spark.createDataFrame([(1, "some words", "en", 0.5, "x")], "doc_id bigint, Text string, lang string, score double, `a.b` string")
    assert corpus_pipeline.identify_language(spark, docs, "").collect() == docs.collect()
    assert [f.dataType.simpleString() for f in sent[0]] == ["bigint", "string", "string", "double", "string"]
