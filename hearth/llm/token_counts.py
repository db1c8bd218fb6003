"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from .bpe import counts_of, encoder
from .common import stage, text_of

LIMIT = 1024
CACHE_SCHEMA = "digest binary, version string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file never meets the counts of this one."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer, one row per digest even after a repeated append."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, *, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a tokenizers ``.json`` file on every worker,
    ``cache`` a folder of counts that all workers share; it is made if absent. A
    content is the whole text, a null one as empty. Contents without a count are
    encoded once each and appended to the cache; then all rows take their count
    from it. A run that dies leaves whole files of the cache, which stay right.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    version = tokenizer_version(tokenizer)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    texts = docs.select("doc_id", text_of(docs).alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))
    )
    digests = stage(texts.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest"), "digests")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(tokenizer)
        for batch in batches:
            counts = pa.array(counts_of(one, batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], names=["digest", "n_tokens"])

    missing = digests.select("digest").distinct().join(read_cache(spark, cache, version), "digest", "left_anti")
    (
        texts.select("digest", "text")
        .dropDuplicates(["digest"])
        .join(missing, "digest", "left_semi")
        .select("digest", "text")
        .mapInArrow(encode, "digest binary, n_tokens bigint")
        .select("digest", F.lit(version).alias("version"), "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    # both sides written: adaptive execution can then split a digest that very many rows share
    counts = stage(read_cache(spark, cache, version), "counts")
    return digests.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
