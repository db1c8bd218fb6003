"""Corpus pipeline: from documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and, but for the last, returns the columns of ``docs``. Results are written
as Parquet and reread, so every stage starts from finished files. Further columns
of ``docs`` pass through whatever their names; a null text counts as empty; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import decontaminate, language, line_dedup, minhash, packing
from hearth.llm.common import stage, table, text_of
from hearth.llm.features import held_out
from hearth.llm.queries import TOKENIZER
from hearth.session import configure

NEAR_DUPLICATE_PERCENT = 80


def _with_row(docs: DataFrame) -> DataFrame:
    """Id and text beside the whole row, so that no column of ``docs`` meets an operator's own."""
    return docs.select("doc_id", "text", F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("whole_row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in no learned language, by the share of
    n-grams that the training documents know; texts of several languages stay."""
    learned = docs.filter(~held_out(docs, *language.FOLDS)).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    model = language.train(learned)
    # columns by their place, so that none meets an operator's own and a text goes to a worker once
    names = ["text" if name.lower() == "text" else f"column_{place}" for place, name in enumerate(docs.columns)]
    found = language.identify(docs.toDF(*names), model, familiar=True).filter(F.col("lang_pred") != language.UNKNOWN)
    return found.select(*[F.col(name).alias(own) for name, own in zip(names, docs.columns, strict=True)])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes frequent lines out of the texts; ``n_chars`` follows. All documents stay."""
    found = line_dedup.drop_frequent_lines(_with_row(docs))
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    columns = []
    for field in docs.schema:
        old = F.col("whole_row")[field.name]
        if field.name in new:
            old = F.when(changed, new[field.name].cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return found.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest id; a
    repeated id stays if any of its rows does."""
    found = minhash.near_duplicates(docs.select("doc_id", "text"), percent=NEAR_DUPLICATE_PERCENT)
    kept = stage(found.filter("kept").select(F.col("doc_id").alias("kept_id")).distinct(), "kept")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the ids of documents that hold a window of a benchmark item."""
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leaks = stage(found.filter("contaminated").select(F.col("doc_id").alias("leak_id")).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak_id"]), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return packing.pack(docs.select("doc_id", text_of(docs).alias("text")), TOKENIZER).drop("ids")


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Language identification is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and reread."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
