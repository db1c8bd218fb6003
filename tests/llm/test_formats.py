"""Formats learned from labelled credentials: structure, recall, false positives, spans."""

import math
import random
import re
import string

import pytest

from hearth.llm import automata, secret_scan

ALNUM = string.ascii_letters + string.digits
FORMATS = {
    "prefixed": lambda r: "tok_" + "".join(r.choices(ALNUM, k=24)),
    "short": lambda r: "pw-" + "".join(r.choices(string.digits, k=5)),
    "upper hex": lambda r: "".join(r.choices("0123456789ABCDEF", k=40)),
    "long": lambda r: "eyJ" + "".join(r.choices(ALNUM + "-_", k=180)) + "." + "".join(r.choices(ALNUM + "-_", k=43)),
    "dashed": lambda r: "-".join("".join(r.choices("abcdef0123456789", k=k)) for k in (8, 4, 4, 4, 12)),
}
SYLLABLES = "the and ion ing er ed in on st re al ent tion ver ge zu lich heit qu".split()


def prose(r, words):
    return " ".join("".join(r.choices(SYLLABLES, k=r.randint(1, 9))) for _ in range(words))


@pytest.mark.parametrize("name, states", [("prefixed", 5), ("short", 4), ("long", 5), ("upper hex", 1)])
@pytest.mark.parametrize("strings", [40, 400])
def test_states_follow_the_format(name, states, strings):
    """Fixed characters stay states of their own, random parts become loops."""
    r = random.Random(5)
    one = automata.infer([FORMATS[name](r) for _ in range(strings)])
    assert states <= one.states <= states + (4 if name != "long" else 20)


def plain_log_likelihood(one, text):
    state, total = 0, one.length_log(len(text))
    for char in text:
        total += one.step[state, ord(char)]
        state = one.next[state, ord(char)]
    return total


def test_scores_of_many_equal_those_of_each():
    r = random.Random(6)
    one = automata.infer([FORMATS["prefixed"](r) for _ in range(60)])
    texts = [FORMATS[name](r) for name in FORMATS for _ in range(20)] + ["a", "tok_", "x" * 5000, "tok_" + "é".encode().hex()]
    for text, found in zip(texts, one.log_likelihoods(texts), strict=True):
        assert math.isclose(found, plain_log_likelihood(one, text), rel_tol=1e-12)
    assert one.log_likelihoods([]).size == 0
    # each state's predictions add up to one
    for state in range(one.states):
        assert abs(sum(math.exp(v) for v in one.step[state]) - 1) < 1.0


@pytest.mark.parametrize("strings", [["zz"], ["zz", "zz"], ["a" * 2000]])
def test_formats_of_little(strings):
    one = automata.infer(strings)
    assert one.log_likelihoods(["something-else"])[0] < one.log_likelihoods(strings[:1])[0]


def corpus(seed, documents, loose):
    """Credentials behind keywords, and others that no fixed rule can find."""
    r, rows, planted = random.Random(seed), [], {}
    for i in range(documents):
        name = list(FORMATS)[i % len(FORMATS)]
        rows.append((i, f"{prose(r, 40)} api_key = \"{FORMATS[name](r)}\" {prose(r, 10)}"))
    for i in range(documents, documents + loose):
        name = list(FORMATS)[i % len(FORMATS)]
        value, before = FORMATS[name](r), prose(r, 40)
        rows.append((i, f"{before} {value} {prose(r, 10)}"))
        planted[i] = (name, len(before) + 1, value)
    return rows, planted


def plain_added(formats, text, base, min_ratio):
    """Every run of credential characters that no base span touches, scored one by one."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text):
        if len(m[0]) < formats.shortest or any(b.begin < m.end() and m.start() < b.end for b in base):
            continue
        other = plain_log_likelihood(formats.ordinary, m[0])
        own = [(plain_log_likelihood(k.automaton, m[0]), k.least) for k in formats.kinds]
        if any(ll >= least * len(m[0]) and ll - other >= min_ratio * len(m[0]) for ll, least in own):
            out.append((m.start(), m.end(), m[0]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_held_out_credentials_are_found(spark, seed):
    """Recall of at least 0.9 for each format at a false positive in a thousand ordinary strings."""
    rows, planted = corpus(seed, 250, 300)
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    formats = secret_scan.learn_formats(docs)
    assert formats.shortest == 8 and all(kind.automaton.states > 1 for kind in formats.kinds)
    found = {r.doc_id: r for r in secret_scan.find_secrets(docs).collect()}
    hits = {name: [] for name in FORMATS}
    for i, (name, begin, value) in planted.items():
        assert not any(s.value == value for s in found[i].base)
        hits[name].append((begin, begin + len(value)) in [(s.begin, s.end) for s in found[i].added])
    recall = {name: sum(own) / len(own) for name, own in hits.items()}
    assert min(recall.values()) >= 0.9, recall
    wrong = sum((i, s.value) not in {(i, planted[i][2]) if i in planted else None} for i, r in found.items() for s in r.added)
    ordinary = sum(len(w) >= formats.shortest for _, text in rows for w in text.split())
    assert wrong <= ordinary / 1000, (wrong, ordinary)
    texts = dict(rows)
    for i, r in list(found.items())[::7]:
        assert [(s.begin, s.end, s.value) for s in r.added] == plain_added(formats, texts[i], r.base, secret_scan.MIN_RATIO)


def test_samples_do_not_depend_on_partitions(spark):
    rows, _ = corpus(3, 60, 0)
    docs = spark.createDataFrame(rows + [(None, None), (1, "")], "doc_id int, text string")
    one, many = (secret_scan.learn_formats(docs.repartition(n), most=20) for n in (1, 9))
    texts = ["tok_" + "a1B2" * 6, "thereofthe", "x" * 40]
    assert one.accepts(texts, 0.0).tolist() == many.accepts(texts, 0.0).tolist() and one.shortest == many.shortest
    for a, b in zip(one.kinds, many.kinds, strict=True):
        assert a.least == b.least and (a.automaton.step == b.automaton.step).all()
    assert one.ordinary.strings == 19


def test_nothing_labelled_adds_nothing(spark):
    docs = spark.createDataFrame([(1, "tok_" + "a1B2" * 6), (2, None)], "doc_id int, text string")
    assert secret_scan.learn_formats(docs) is None
    assert [r.added for r in secret_scan.find_secrets(docs).collect()] == [[], []]
