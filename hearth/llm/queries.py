"""Registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from . import conversations, decontaminate, language, line_dedup, minhash, packing, quality, quality_rules, resampling, secret_scan, substring_dedup, token_counts, topk
from .common import table

# One of the vocabulary files that the box offers; operators take any path.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(configure(spark), sf_dir, "documents"), TOKENIZER).drop("ids")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(configure(spark), sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other
), names AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN names m USING (doc_id)
"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS key, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT p.doc_id, p.i, p.size, x.item_id FROM places p JOIN windows x ON p.key = x.key AND p.size = x.size
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM words d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_frequent_lines(table(configure(spark), sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id <> f.keeper, false) AS dropped
  FROM lines l LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(configure(spark), sf_dir, "embeddings"))


OP6_SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q, vectors c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 10
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(configure(spark), sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.find_repeats(table(configure(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


OP8_SQL = """
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), strings AS (
  SELECT doc_id, i, array_slice(b, i + 1, i + 50) AS s
  FROM (SELECT doc_id, b, unnest(range(0, n - 49)) AS i FROM docs WHERE n >= 50)
), owners AS (
  SELECT s, min(doc_id) AS least FROM strings GROUP BY s
), starts AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS fresh
  FROM strings JOIN owners USING (s) WHERE least < doc_id
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS z
  FROM (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts)
  GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
  UNION ALL
  SELECT doc_id, coalesce(last, 0), n FROM docs LEFT JOIN (SELECT doc_id, max(z) AS last FROM spans GROUP BY doc_id) USING (doc_id)
), kept AS (
  SELECT doc_id, sha256(unhex(string_agg(substr(hex(b), 2 * a + 1, 2 * (z - a)), '' ORDER BY a))) AS kept_sha256
  FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id
), removed AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(configure(spark), sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    kinds = F.array(*[F.lit(kind) for kind in secret_scan.KINDS])
    ordered = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["begin"].alias("begin"), F.array_position(kinds, s["kind"]).alias("place"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.encode(listed("base"), "UTF-8"), 256).alias("base_sha256"),
        listed(ordered).alias("spans"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every content is a miss."""
    docs = table(configure(spark), sf_dir, "documents")
    return token_counts.count_tokens(docs, TOKENIZER, scratch_path(spark, "token-cache"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# The CRC table comes from its polynomial; a word's CRC folds its bytes.
OP11_SQL = r"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS steps
), texts AS (
  SELECT row_number() OVER () AS place, doc_id, text, false AS target FROM documents
  UNION ALL SELECT row_number() OVER (), NULL, text, true FROM benchmark
), words AS (
  SELECT place, target, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), hashed AS (
  SELECT word, xor(list_reduce(
      list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), polynomial
), counts AS (
  SELECT bucket, count(*) FILTER (WHERE NOT target) AS s, count(*) FILTER (WHERE target) AS t
  FROM words JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (all_s + 10000) / (CAST(s + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM counts, (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM counts)
), weights AS (
  SELECT place, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE NOT target GROUP BY place
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (place) WHERE NOT target
), ranked AS (
  SELECT *, n_features >= 20 AS may, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(configure(spark), sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT place, i, array_to_string(w[i:i + 4], ' ') AS key
  FROM (SELECT place, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)
), repeats AS (
  SELECT place, count(DISTINCT spot) AS n FROM (
    SELECT place, unnest(range(i, i + 5)) AS spot
    FROM (SELECT place, i, count(*) OVER (PARTITION BY place, key) AS times FROM windows) WHERE times > 1
  ) GROUP BY place
), lines AS (
  SELECT place, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
    count(*) FILTER (WHERE regexp_matches(line, '^ *[-*•]')) AS bullets,
    count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…) *$')) AS unended
  FROM (SELECT place, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY place
), words AS (
  SELECT place, count(*) AS n, sum(length(word)) AS chars,
    count(*) FILTER (WHERE lower(word) IN (STOP_WORDS)) AS stop,
    count(*) FILTER (WHERE regexp_matches(word, '\p{Lu}') AND NOT regexp_matches(word, '\p{Ll}') AND length(word) > 1) AS capital,
    count(*) FILTER (WHERE regexp_matches(word, '\p{L}')) AS letter
  FROM (SELECT place, unnest(w) AS word FROM docs) GROUP BY place
), measured AS (
  SELECT doc_id, coalesce(w.n, 0) AS n_words, CAST(coalesce(w.chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, w.stop, w.capital, w.letter, l.n AS n_lines, l.bullets, l.unended
  FROM docs LEFT JOIN words w USING (place) LEFT JOIN lines l USING (place) LEFT JOIN repeats r USING (place)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words AND word_chars BETWEEN 2 * n_words AND 12 * n_words
    AND 10 * (n_symbols - 2) <= n_words AND 50 * (stop + 1) >= n_words AND 2 * (capital - 2) <= n_words
    AND 2 * (letter + 1) >= n_words AND 10 * (n_dup_lines - 1) <= 3 * n_lines
    AND 10 * (bullets - 1) <= 9 * n_lines AND 10 * (unended - 1) <= 3 * n_lines AS kept
FROM measured
""".replace("STOP_WORDS", ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = conversations.damaged(table(configure(spark), sf_dir, "conversations"))
    return conversations.repair(rows, also=dropped)


# STEP and IW are spelled out below. From the last row back to the first: for each state the cheapest way to the end, as
# cost, edits and lines; comparing such structs compares costs first, then edits.
_OP13_SHORT = r"""
WITH RECURSIVE polynomial AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS steps
), coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      list_transform(range(octet_length(encode(name))), lambda i: CAST('0x' || substr(hex(encode(name)), 2 * i + 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 20 AS code
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations), polynomial
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded
), rows AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault
  FROM damaged
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM rows) GROUP BY conv_id
), ways AS (
  SELECT conv_id, n AS i, {'c': 0, 'a': '', 't': ''} AS w0, {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS w1,
    {'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'} AS w2, {'c': 0, 'a': '', 't': ''} AS w3
  FROM counted
  UNION ALL
  SELECT conv_id, i, IW(v0, v2, v3, 'user:', 'assistant:'), IW(v1, v2, v3, 'user:', 'assistant:'), IW(v2, v3, v2, 'assistant:', 'user:'),
    IW(v3, v2, v3, 'user:', 'assistant:')
  FROM (SELECT w.conv_id, w.i - 1 AS i, STEP(w0, w2, w1, 's', w2, 'u', 'user:') AS v0, STEP(w1, w2, w2, 'u', w2, 'u', 'user:') AS v1,
      STEP(w2, w3, w3, 'a', w3, 'a', 'assistant:') AS v2, STEP(w3, w2, w2, 'u', w2, 'u', 'user:') AS v3
    FROM ways w JOIN rows r ON r.i = w.i AND r.conv_id IS NOT DISTINCT FROM w.conv_id)
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT d.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(w.w0.c, 0) AS BIGINT) AS cost,
  coalesce(w.w0.a, '') AS audit, sha256(coalesce(w.w0.t[2:], '')) AS repaired_sha256
FROM ids d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM d.conv_id AND w.i = 0
"""


def _spelled_out(sql: str) -> str:
    """The two repeated expressions of ``_OP13_SHORT``: edits of a row, and insertions before it."""

    def step(own, rerole, keep, initial, keep2, initial2, given):
        more = "CASE fault WHEN 3 THEN 1 ELSE 0 END"
        never = "CASE WHEN fault IN (1, 2) THEN 1000000 ELSE 0 END"
        line = "chr(10) || role || ':' || text"
        kept = [
            f"{{'c': {w}.c + {more} + {never} + CASE WHEN initial = {at} THEN 0 ELSE 1000000 END, 'a': 'K' || {w}.a, 't': {line} || {w}.t}}"
            for w, at in ((keep, initial), (keep2, initial2))
        ]
        other = f"{{'c': {rerole}.c + 2 + {more} + {never}, 'a': 'R' || {rerole}.a, 't': chr(10) || {given} || text || {rerole}.t}}"
        return f"list_sort([{{'c': {own}.c + 3, 'a': 'D' || {own}.a, 't': {own}.t}}, {other}, {', '.join(kept)}])[1]"

    def insert(own, one, two, first, second):
        once = f"{{'c': {one}.c + 2, 'a': 'I' || {one}.a, 't': chr(10) || {first} || {one}.t}}"
        twice = f"{{'c': {two}.c + 4, 'a': 'II' || {two}.a, 't': chr(10) || {first} || chr(10) || {second} || {two}.t}}"
        return f"list_sort([{own}, {once}, {twice}])[1]"

    for name, build in (("STEP", step), ("IW", insert)):
        sql = re.sub(rf"\b{name}\(([^()]*)\)", lambda m, build=build: build(*m[1].split(", ")), sql)
    return sql


OP13_SQL = _spelled_out(_OP13_SHORT)


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_topk": op6_topk,
    "op7_language": op7_language,
    "op8_substrings": op8_substrings,
    "op9_secrets": op9_secrets,
    "op10_token_counts": op10_token_counts,
    "op11_resampling": op11_resampling,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversations": op13_conversations,
}

SQL: dict[str, str] = {
    "op3_near_duplicates": OP3_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op6_topk": OP6_SQL,
    "op8_substrings": OP8_SQL,
    "op11_resampling": OP11_SQL,
    "op12_quality_rules": OP12_SQL,
    "op13_conversations": OP13_SQL,
}
