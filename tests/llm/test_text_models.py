"""Learned operators: held-out accuracy, and awkward rows."""

import re
import zlib

import numpy as np
import pytest
from brute import sha

from hearth.llm import features, language, quality, queries, secret_scan

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "123 !!!"), (None, "words without an id"), (4, "é"), (4, "a repeated id"), (5, "漢字 " * 20_000), (6, "\n\n")]


def frame(spark, rows):
    columns = "doc_id bigint, text string, lang string, score string, held_out int, lang_pred int"
    return spark.createDataFrame([(i, t, "en", "x", 1, 2) for i, t in rows], columns)


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_language_held_out(spark):
    rows = queries.QUERIES["op7_language"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95
    # calibrated: mean confidence is near the accuracy
    assert abs(np.mean([r.score for r in held]) - np.mean([r.lang_pred == docs[r.doc_id].lang for r in held])) < 0.05
    assert {r.lang_pred for r in rows} <= {d.lang for d in docs.values()} | {"und"}


def test_language_of_awkward_rows(spark):
    rows = language.predict_languages(frame(spark, ODD)).collect()
    assert [c for c in ("doc_id", "held_out", "lang_pred", "score") if c not in rows[0].asDict()] == []
    undetermined = {(1, None), (2, ""), (3, "123 !!!"), (6, "\n\n")}
    assert sum(r.lang_pred == "und" and r.score == 0 for r in rows) == len(undetermined)
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = frame(spark, ODD).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in language.predict_languages(none).collect()} == {("und", 0.0)}
    assert language.predict_languages(frame(spark, [])).count() == 0


def test_ftrl_learns_and_more_l1_leaves_fewer_weights():
    zeros = []
    for l1 in (0.0, 12.0):
        rng, model = np.random.default_rng(2), language.Ftrl(2, 50, l1=l1)
        for _ in range(400):
            at = np.sort(rng.choice(50, 5, replace=False))
            model.learn(at, np.ones(5), int(0 in at))
        w = model.weights()
        assert w[1, 0] - w[0, 0] > 1
        zeros.append((w == 0).mean())
    assert zeros[0] == 0 and zeros[1] > 0.2


def test_quality_held_out(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op1_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.9
    assert np.mean([r.predicted for r, q in held if q == 1]) > 0.97


def test_quality_ignores_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    crc = "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 4) = 2 THEN 1 - quality ELSE quality END"
    turned = labels.selectExpr("doc_id", f"{crc} AS quality")
    few = docs.filter("doc_id < 100")
    a = quality.score_quality(few, labels, max_docs=300).orderBy("doc_id").collect()
    b = quality.score_quality(few, turned, max_docs=300).orderBy("doc_id").collect()
    assert a == b


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1, "x"), (4, 0, "y"), (5, None, "z"), (None, 1, "w"), (6, 3, "v")], "doc_id bigint, quality int, text string")
    rows = quality.score_quality(frame(spark, ODD), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    rows = quality.score_quality(frame(spark, ODD), labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.5}
    assert quality.score_quality(frame(spark, []), labels).count() == 0


def test_ngrams_stay_in_their_text():
    together = features.Characters.of(["abc", "", "de"])
    for order in (1, 2, 3):
        bucket, whole = together.ngrams(order, 16)
        for d, text in enumerate(["abc", "", "de"]):
            own = slice(together.begin[d], together.begin[d + 1])
            alone = features.Characters.of([text])
            b, w = alone.ngrams(order, 16)
            assert whole[own].tolist() == w.tolist() and bucket[own][w].tolist() == b[w].tolist()
    words, places = features.Characters.of(["one two", "two  one"]).words(16)
    assert words.tolist() == [words[0], words[1], words[1], words[0]] and places.tolist() == [0, 4, 8, 13]


def plain_base(text):
    """The fixed rules, straight from their definition."""
    rules = [
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ]
    found = [(m.start(), k, m.end(), name) for k, (name, rule, group, least) in enumerate(rules) for m in rule.finditer(text or "") if len(m[group]) >= least]
    return [f"{name}:{begin}:{end}" for begin, _, end, name in sorted(found)]


SECRETS = [
    "token = abcdef", "TOKEN='abc'", "api_key: \"x/y+z_1=-\" apikey=123456", "ſecret=abcdefgh", "toKen=abcdefgh", "password=passwd=secret1",
    "x" + "0123456789abcdef" * 2 + "y", "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 11, "AKIA" + "Z" * 15, "é token:　abcdefg", "secret = " + "f" * 24 + " AKIA" + "1" * 20,
    "deadbeef" * 3 + "G" + "deadbeef" * 2, "a" * 100_000, "ghp_" + "aB3" * 12 + " plain", None, "", "token=" + "A" * 5 + " token=" + "b" * 7,
]


def test_base_rules():
    for text in SECRETS:
        assert [f"{k}:{b}:{e}" for k, b, e, _ in secret_scan.base_spans(text or "")] == plain_base(text), text


def test_secrets(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(SECRETS)] + [(0, "token = abcdef", "y"), (None, "hex " + "1a" * 12, "z")], "doc_id bigint, text string, spans string")
    rows = secret_scan.find_secrets(docs).collect()
    expected = sorted((str(r.doc_id), plain_base(r.text)) for r in docs.collect())
    assert sorted((str(r.doc_id), [f"{s.kind}:{s.begin}:{s.end}" for s in r.base]) for r in rows) == expected
    for r in rows:  # added spans touch no base span
        assert all(a.end <= b.begin or a.begin >= b.end for a in r.added for b in r.base)
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


def test_secrets_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_secrets"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        assert r.base_sha256 == sha(",".join(base))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k in ("assign:", "access:", "hex:"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("format")] == base
