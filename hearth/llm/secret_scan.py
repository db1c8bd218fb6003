"""Secrets in texts: fixed rules, and formats learned from what the rules find."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automata import TAUGHT_CHARS, Automaton, infer
from .common import stage, text_of

KINDS = ("assign", "access", "hex", "format")
# Bounds of the sample that automata are inferred from: distinct strings of each labelled
# kind and of ordinary ones, those of the least hash, and characters of each.
MAX_EXAMPLES = 1000
MAX_EXAMPLE_CHARS = 60_000
# Mean logarithm per character by which a string must be likelier in its format than as an
# ordinary one, and by which it may be less likely than the least likely string taught.
MIN_RATIO = 0.5
SLACK = 0.3
# Share of the ordinary strings taken for credentials that no rule found.
OUTLIERS = 0.05
# Strings of fewer characters are no credentials by any rule.
SHORTEST = 6

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A rule's run of characters is taken whole; only its start is searched for.
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

_SPAN = "struct<kind:string,begin:int,end:int,value:string>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, begin, end, credential)`` of the fixed rules; a span is the whole match, in code points."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        found += [("assign", *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: tuple) -> tuple:
    return span[1], KINDS.index(span[0])


def _candidate_rule(shortest: int) -> re.Pattern:
    return re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{shortest},}}")


def candidates(text: str, base: list[tuple], rule: re.Pattern) -> list[tuple[str, int, int, str]]:
    """Whole runs of credential characters that no base span touches."""
    taken: list[list[int]] = []  # disjoint, in order
    for _, begin, end, _ in base:
        if taken and begin < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([begin, end])
    found, at = [], 0
    for m in rule.finditer(text):
        begin, end = m.span()
        while at < len(taken) and taken[at][1] <= begin:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            found.append(("format", begin, end, m[0]))
    return found


@dataclass
class Format:
    """One learned kind, and the least mean logarithm per character that is typical of it."""

    automaton: Automaton
    least: float


@dataclass
class Formats:
    """Automata of the credential kinds and one of ordinary strings."""

    kinds: list[Format]
    ordinary: Automaton
    shortest: int

    def accepts(self, strings: list[str], min_ratio: float) -> np.ndarray:
        """Whether each string is typical of a format and ``min_ratio`` likelier in it than as an ordinary one."""
        sizes = np.array([len(one) for one in strings], np.int64)
        other = self.ordinary.log_likelihoods(strings)
        found = np.zeros(len(strings), bool)
        for kind in self.kinds:
            own = kind.automaton.log_likelihoods(strings)
            found |= (own >= kind.least * sizes) & (own - other >= min_ratio * sizes)
        return found


class Least:
    """The distinct strings of least hash, ``most`` of them."""

    def __init__(self, most: int) -> None:
        self.most, self.bound, self.kept = most, 1 << 32, {}

    def add(self, strings) -> None:
        for one in strings:
            h = zlib.crc32(one.encode())
            if h < self.bound:
                self.kept[one] = h
                if len(self.kept) >= 2 * self.most:
                    self._trim()

    def _trim(self) -> None:
        order = sorted(self.kept.items(), key=lambda e: (e[1], e[0]))[: self.most]
        self.kept = dict(order)
        if len(order) == self.most:
            self.bound = order[-1][1] + 1

    def rows(self) -> list[tuple[str, int]]:
        self._trim()
        return list(self.kept.items())


def examples(docs: DataFrame, most: int = MAX_EXAMPLES) -> DataFrame:
    """``kind, value, hash``: of each task's texts, the distinct credentials of each kind and
    ordinary strings (kind ``format``) of least hash, at most ``most`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {kind: Least(most) for kind in KINDS}
        rule = _candidate_rule(SHORTEST)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                for kind, _, _, value in base:
                    found[kind].add([value])
                words = rule.findall(text) if not base else [value for _, _, _, value in candidates(text, base, rule)]
                found["format"].add(words)
        rows = [(kind, value, h) for kind, least in found.items() for value, h in least.rows()]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "value", "hash"])

    return docs.select(text_of(docs).alias("text")).mapInArrow(run, "kind string, value string, hash bigint")


def _taught(strings: list[str]) -> list[str]:
    """As many as the bound on characters allows, one at least."""
    kept, total = [], 0
    for one in strings:
        total += min(len(one), TAUGHT_CHARS)
        if kept and total > MAX_EXAMPLE_CHARS:
            break
        kept.append(one)
    return kept


def _ordinary(strings: list[str]) -> Automaton:
    """The automaton of ordinary strings. Credentials that no rule found are among them:
    those least likely by a first automaton do not teach the second."""
    first = infer(strings)
    mean = first.log_likelihoods(strings) / [len(one) for one in strings]
    kept = np.argsort(-mean, kind="stable")[: max(1, round(len(strings) * (1 - OUTLIERS)))]
    return infer([strings[i] for i in sorted(kept)])


def learn_formats(docs: DataFrame, *, most: int = MAX_EXAMPLES) -> Formats | None:
    """Automata from the credentials that the fixed rules label and from strings that they
    leave alone; None while either is missing."""
    found = stage(examples(docs, most), "examples").distinct()
    by_kind = {
        kind: [r["value"] for r in found.filter(F.col("kind") == kind).orderBy("hash", "value").limit(most).collect()] for kind in KINDS
    }
    ordinary = _taught(by_kind.pop("format"))
    labelled = {kind: _taught(strings) for kind, strings in by_kind.items() if strings}
    if not labelled or not ordinary:
        return None
    kinds = []
    for strings in labelled.values():
        automaton = infer(strings)
        typical = automaton.log_likelihoods(strings) / [len(one) for one in strings]
        kinds.append(Format(automaton, float(typical.min()) - SLACK))
    return Formats(kinds, _ordinary(ordinary), min(len(one) for strings in labelled.values() for one in strings))


def find_secrets(docs: DataFrame, *, min_ratio: float = MIN_RATIO, most: int = MAX_EXAMPLES) -> DataFrame:
    """``doc_id, base, added`` per row of ``docs``: spans ``(kind, begin, end, value)``.

    ``base`` has the spans of the fixed rules over the whole text. The credentials in them
    are the labelled strings of each kind, and runs of credential characters outside them
    are the ordinary ones; of both the distinct strings of least hash are a bounded sample.
    States of their prefix trees are merged where they are statistically compatible. Every
    run outside base spans that is at least as long as the shortest credential taught is
    scored by the automata; those that are typical of a format and ``min_ratio`` likelier
    per character in it than as an ordinary string are ``added`` with the kind ``format``.
    A null text has no spans; with nothing labelled, nothing is added. Texts are read
    twice, by narrow passes.
    """
    formats = learn_formats(docs, most=most)
    rule = _candidate_rule(formats.shortest) if formats is not None else None
    span = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
    names = ("kind", "begin", "end", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(text) for text in texts]
            added: list[list[tuple]] = [[] for _ in texts]
            if formats is not None:
                open_ = [candidates(text, spans, rule) for text, spans in zip(texts, base, strict=True)]
                distinct = sorted({one[3] for own in open_ for one in own})
                good = {one for one, is_good in zip(distinct, formats.accepts(distinct, min_ratio), strict=True) if is_good}
                added = [[one for one in own if one[3] in good] for own in open_]
            columns = [pa.array([[dict(zip(names, s, strict=True)) for s in own] for own in rows], span) for rows in (base, added)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "base", "added"])

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_kind}, base array<{_SPAN}>, added array<{_SPAN}>")
