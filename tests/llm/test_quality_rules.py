"""Quality rules against a plain version and SQL, on awkward rows."""

import re
from collections import defaultdict

import oracle
import pytest
import regex

from hearth.llm import queries, quality_rules

SF = "/root/testdata/sf0.01"
EXTRA = "doc_id bigint, text string, words array<string>, failed string, n_words string, kept int, one int"


def plain(text, window=5):
    """The measures of one text, in the order of MEASURES."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = defaultdict(list)
    for i in range(len(words) - window + 1):
        places[tuple(words[i : i + window])].append(i)
    repeated = {at for found in places.values() if len(found) > 1 for i in found for at in range(i, i + window)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(repeated),
        sum(word.lower() in quality_rules.STOP_WORDS for word in words),
        sum(len(w) > 1 and bool(regex.search(r"\p{Lu}", w)) and not regex.search(r"\p{Ll}", w) for w in words),
        sum(bool(regex.search(r"\p{L}", word)) for word in words),
        sum(bool(re.match(r" *[-*•]", line)) for line in lines),
        sum(bool(re.search(r"(\.\.\.|…) *$", line)) for line in lines),
    )


ODD = [
    None, "", " \t\n\x0b\x0c\r", "a", "one two three four", "a b c d e", "a a a a a a", "a b c d e a b c d e",
    "a b c d e f a b c d", "a b c d e x a b c d e f y b c d e f", "tab\tand\x0bfeed\x0c \x1f\xa0 x", "\r\nline\r\nline\r\n",
    "- one\n - two\n* three\n• four...\nfive … \nsix…", "same\nsame\nsame \n\n\nsame", "ÉTÉ Été été Straße STRASSE ẞ ß İ",
    "The the THE, the", "# * $ % & | < > #*$%&|<>", "漢字 かな 漢字 \U0001f600 \U0001f600", "word " * 3000, "x" * 100_000,
    " ".join(str(i) for i in range(20_000)), "a b c d e f g h " * 40, "\x00 \x01",
]


def test_measures_equal_a_plain_count(spark):
    rows = [(i, text, ["x"], "f", "n", 1, 2) for i, text in enumerate(ODD)]
    rows += [(None, "no id", None, None, None, None, None), (3, ODD[3], None, "again", None, 0, 0)]
    found = quality_rules.apply_rules(spark.createDataFrame(rows, EXTRA)).collect()
    expected = sorted((str(row[0]), *plain(row[1])) for row in rows)
    assert sorted((str(r.doc_id), *[r[name] for name in quality_rules.MEASURES]) for r in found) == expected


@pytest.mark.parametrize("window", [1, 2, 7])
def test_other_windows(spark, window):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id int, text string")
    found = {r.doc_id: r.n_repeat_words for r in quality_rules.measure(docs, window=window).collect()}
    assert found == {i: plain(text, window)[5] for i, text in enumerate(ODD)}


def judge(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: r for r in quality_rules.apply_rules(docs, **options).collect()}


def test_each_rule_names_itself(spark):
    prose = "The house of the river is old and it was built by hand for a man with no name in town."
    violations = {
        "few_words": "the house is old",
        "repeated_words": prose + " it is what it is and it is what it is and so on for us",
        "word_length": " ".join(["the of and to in"] + ["a" * 15 + chr(97 + i) for i in range(20)]),
        "symbols": prose + " # # # # #",
        "stop_words": " ".join(f"Word{i}x" for i in range(60)),
        "capitals": " ".join(f"LOUD{chr(65 + i)}" for i in range(20)) + " the of",
        "letters": " ".join(map(str, range(10, 50))) + " the of",
        "repeated_lines": prose + "\nthe same" * 5,
        "bullet_lines": "\n".join(f"- the item {chr(97 + i)}" for i in range(20)),
        "open_lines": "\n".join(f"the item {chr(97 + i)} ..." for i in range(20)),
    }
    found = judge(spark, [prose, *violations.values()])
    assert found[0].kept and not found[0].base_failed and found[0].failed == []
    for row, name in zip(list(found.values())[1:], violations, strict=True):
        assert name in row.failed and not row.kept, name
        assert row.base_failed == any(rule.name in row.failed for rule in quality_rules.BASE)


def test_bounds_are_exact(spark):
    """A ratio that lies on its bound passes, one step further fails."""
    rule = quality_rules.Rule("symbols", "n_symbols", "n_words", least=100, most=200)
    texts = ["a b c d e f g h i #", "a b c d e f g h # #", "a b c d e f g # # #", "a b c d e f g h i j"]
    found = judge(spark, texts, rules=[rule], base=[])
    assert [found[i].kept for i in range(4)] == [True, True, False, False]
    assert all(row.kept for row in judge(spark, texts, rules=[], base=[]).values())


def test_no_rows(spark):
    found = quality_rules.apply_rules(spark.createDataFrame([], EXTRA))
    assert found.columns == ["doc_id", *quality_rules.MEASURES, "failed", "base_failed", "kept"] and found.count() == 0


def test_one_narrow_projection(spark):
    plan = queries.QUERIES["op12_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql_and_keeps_good_documents(spark):
    found = queries.QUERIES["op12_quality_rules"](spark, SF)
    assert oracle.difference(found, oracle.connect(SF), queries.SQL["op12_quality_rules"]) is None
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = found.join(labels.filter("quality = 1"), "doc_id").filter("NOT base_failed")
    assert good.count() > 200 and good.filter("kept").count() >= 0.99 * good.count()
    bad = found.join(labels.filter("quality = 0"), "doc_id")
    assert bad.filter("NOT kept").count() >= 0.9 * bad.count()
