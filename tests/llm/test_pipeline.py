"""The pipeline's stages on their own inputs."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F
from test_dedup import awkward
from test_tokens import PATH, check_packing
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

STAGES = dict(pipeline.STAGES)
EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept_text string, whole_row int, `odd name.` string"


@pytest.fixture(scope="module")
def folder_of_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    base = next(t for i, t in awkward() if i == 22)
    items = [(1, " ".join(base.split(" ")[48:70])), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 3, "z") for i, t in awkward()], EXTRA).write.parquet(f"{folder}/documents.parquet")
    return folder


def docs_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_names_and_order():
    assert [name for name, _ in pipeline.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_language(spark, folder_of_tables):
    docs = docs_of(spark, folder_of_tables)
    kept = STAGES["language"](spark, docs, folder_of_tables)
    assert kept.columns == docs.columns
    # one language is sure of everything that has a letter
    assert pairs(kept) == Counter({k: n for k, n in pairs(docs).items() if any(map(str.isalpha, k[1] or ""))})


FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."
RUSSIAN = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства."


@pytest.mark.parametrize("languages", [["en"], ["de", "en"], ["de", "en", "es", "fr"]])
def test_language_rejects_what_was_not_learned(spark, languages):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.col("lang").isin(languages))
    rng = random.Random(2)
    gibberish = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(80))
    clean = {lang: docs.filter(F.col("lang") == lang).orderBy("doc_id").first().text for lang in languages}
    mixed = [clean[a][:400] + "\n" + clean[b][:400] for a in languages for b in languages]
    added = [(10**9 + i, t) for i, t in enumerate([FINNISH, RUSSIAN, gibberish, *mixed])]
    extra = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in added], docs.schema)
    kept = {r.doc_id for r in STAGES["language"](spark, docs.unionByName(extra), "").collect()}
    assert not kept & {10**9, 10**9 + 1, 10**9 + 2}
    assert {i for i, _ in added[3:]} <= kept
    assert {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))} <= kept


def test_line_dedup(spark, folder_of_tables):
    docs = docs_of(spark, folder_of_tables)
    kept = STAGES["line_dedup"](spark, docs, folder_of_tables)
    assert kept.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = Counter((i, kept_text if dropped else text) for (i, text), (_, _, dropped, kept_text) in zip(rows, brute.line_dedup(rows)))
    assert pairs(kept) == expected
    assert all(r.n_chars == len(r.text or "") for r in kept.collect())


def test_near_duplicates(spark, folder_of_tables):
    docs = docs_of(spark, folder_of_tables)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = {i for i, _, _, kept in brute.near_duplicates(rows, 80) if kept}
    kept = STAGES["near_duplicates"](spark, docs, folder_of_tables)
    assert kept.columns == docs.columns and pairs(kept) == Counter(r for r in rows if r[0] in ids)


def test_decontamination(spark, folder_of_tables):
    docs = docs_of(spark, folder_of_tables)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder_of_tables}/benchmark.parquet").collect()]
    leaks = {i for i, _, hit, _ in brute.contamination(rows, items) if hit}
    kept = STAGES["decontamination"](spark, docs, folder_of_tables)
    assert leaks and kept.columns == docs.columns and pairs(kept) == Counter(r for r in rows if r[0] not in leaks)


def test_whole_pipeline(spark, folder_of_tables):
    docs, texts = docs_of(spark, folder_of_tables), {}
    for name, function in pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder_of_tables)
    for row in docs.collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    rows = pipeline.run(spark, folder_of_tables).collect()
    check_packing(rows, texts, 1024, Tokenizer.from_file(PATH))


def test_empty_documents(spark, folder_of_tables):
    docs = docs_of(spark, folder_of_tables).limit(0)
    for _, function in pipeline.STAGES:
        found = function(spark, docs, folder_of_tables)
        assert found.count() == 0
