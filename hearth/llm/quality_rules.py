"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Every rule compares a ratio of two counted measures with bounds, in whole numbers,
so that results do not depend on floating point. No user function, no shuffle: a
row is judged by itself, at a cost of n log n in its words.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "have", "in", "is", "it", "not", "of", "on", "or", "that",
    "the", "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "und", "von", "zu",
    "au", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "al", "como", "con", "del", "el", "es", "los", "las", "lo", "no", "para", "por", "se", "su", "una", "y",
]


@dataclass(frozen=True)
class Rule:
    """``least <= 1000 * part / whole <= most`` in thousandths; an open end is None.

    ``slack`` is granted to ``part`` on either side, so that texts with few words
    are not judged by one word more or less.
    """

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    slack: int = 0

    def passes(self, measures: Callable[[str], Column]) -> Column:
        part, whole = measures(self.part), measures(self.whole)
        bounds = []
        if self.least is not None:
            bounds.append(1000 * (part + self.slack) >= self.least * whole)
        if self.most is not None:
            bounds.append(1000 * (part - self.slack) <= self.most * whole)
        return reduce(and_, bounds)


# What no text may fail, whatever the other rules say.
BASE = [
    Rule("few_words", "n_words", "one", least=10_000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=200),
]

# The method's own rules. Every bound is far from ordinary prose.
RULES = [
    Rule("word_length", "word_chars", "n_words", least=2_000, most=12_000),
    Rule("symbols", "n_symbols", "n_words", most=100, slack=2),
    Rule("stop_words", "n_stop_words", "n_words", least=20, slack=1),
    Rule("capitals", "n_capital_words", "n_words", most=500, slack=2),
    Rule("letters", "n_letter_words", "n_words", least=500, slack=1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=300, slack=1),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900, slack=1),
    Rule("open_lines", "n_open_lines", "n_lines", most=300, slack=1),
]

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_capital_words",
    "n_letter_words", "n_bullet_lines", "n_open_lines",
]


def _long(value: Column) -> Column:
    return value.cast("bigint")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, one: total + one)


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows that occur at least twice in the text.

    Where two windows share a hash, windows with their places are sorted, so that equal
    ones are neighbours; each repeated place then covers the words up to the next one, at
    most a window.
    """

    def covered(places: Column) -> Column:
        return _total(F.transform(places, lambda at, i: _long(F.least(F.coalesce(F.get(places, i + 1) - at, F.lit(window)), F.lit(window)))))

    def repeated(ordered: Column) -> Column:
        def same(one: Column, i: Column) -> Column:
            return F.coalesce(F.get(ordered, i - 1)["key"] == one["key"], F.lit(False)) | F.coalesce(
                F.get(ordered, i + 1)["key"] == one["key"], F.lit(False)
            )

        return let(F.sort_array(F.transform(F.filter(ordered, same), lambda one: one["at"])), covered)

    def exact(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - window + 1)
        windows = F.transform(starts, lambda at: F.struct(F.array_join(F.slice(words, at, F.lit(window)), " ").alias("key"), at.alias("at")))
        return let(F.sort_array(windows), repeated)

    def counted(words: Column) -> Column:
        def distinct(hashes: Column) -> Column:
            """Whether all windows have different hashes; then they are different."""
            starts = F.sequence(F.lit(0), F.size(hashes) - window)
            folded = F.transform(starts, lambda at: F.xxhash64(*[F.get(hashes, at + i) for i in range(window)]))
            return let(folded, lambda found: F.size(F.array_distinct(found)) == F.size(found))

        alone = let(F.transform(words, lambda word: F.xxhash64(word)), distinct)
        return F.when(F.size(words) <= window, F.lit(0).cast("bigint")).when(alone, F.lit(0).cast("bigint")).otherwise(exact(words))

    return let(words, counted)


def _count(values: Column, test: Callable[[Column], Column]) -> Column:
    return _long(F.size(F.filter(values, test)))


def measure(docs: DataFrame, *, window: int = WINDOW, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``doc_id`` and ``MEASURES`` of every row's whole text, a null one as empty.

    Words are what blanks part; a line is what a newline ends, and counts if it
    holds a word. Lines are equal if all their characters are.
    """
    text = text_of(docs)
    stripped = F.btrim(text, F.lit(BLANKS))
    parts = docs.select(
        "doc_id",
        text.alias("text"),
        F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"),
    )
    words, lines = F.col("words"), F.col("lines")

    def capital(word: Column) -> Column:
        return (F.length(word) > 1) & ~word.rlike(r"\p{Ll}") & word.rlike(r"\p{Lu}")  # most words end at the second

    return parts.select(
        "doc_id",
        _long(F.size(words)).alias("n_words"),
        _long(F.length(F.array_join(words, ""))).alias("word_chars"),
        _long(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        _long(F.size(lines)).alias("n_lines"),
        _long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        _repeated_words(words, window).alias("n_repeat_words"),
        _count(words, lambda word: F.lower(word).isin(list(stop_words))).alias("n_stop_words"),
        _count(words, capital).alias("n_capital_words"),
        _count(words, lambda word: word.rlike(r"\p{L}")).alias("n_letter_words"),
        _count(lines, lambda line: F.ltrim(line).rlike(r"^[-*•]")).alias("n_bullet_lines"),
        _count(lines, lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…")).alias("n_open_lines"),
    )


def failed(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row's measures fail, in the order of the table."""

    def named(name: str) -> Column:
        return F.lit(1).cast("bigint") if name == "one" else F.col(name)

    names = [F.when(rule.passes(named), F.lit(None).cast("string")).otherwise(F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def apply_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    base: Sequence[Rule] = BASE,
    window: int = WINDOW,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``MEASURES``, ``failed`` (names), ``base_failed`` and ``kept``.

    A row is kept if it fails no rule of either table. A null text is an empty one
    and fails for its lack of words; repeated ids are judged row by row; further
    columns are passed over; an empty table gives an empty result.
    """
    judged = measure(docs, window=window, stop_words=stop_words).select(
        "doc_id", *MEASURES, failed(base).alias("_base"), failed(rules).alias("_rules")
    )
    return judged.select(
        "doc_id",
        *MEASURES,
        F.concat("_base", "_rules").alias("failed"),
        (F.size("_base") > 0).alias("base_failed"),
        ((F.size("_base") == 0) & (F.size("_rules") == 0)).alias("kept"),
    )
