"""Repair of conversations against a plain search over all edits."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import oracle
import pytest

from hearth.llm import conversations as c
from hearth.llm import queries

SF = "/root/testdata/sf0.01"
EXTRA = "conv_id bigint, turn bigint, role string, text string, conv string, fault int, audit string, h string, is_row string"
ORDINARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows):
    """(cost, audit, lines) by trying every edit; ``rows``: (role, text, fault)."""
    shape = re.compile(r"(s?(ua)+)?")

    def viable(initials):  # a beginning of something in the language
        return any(shape.fullmatch(initials + end) for end in ("", "ua", "a", "uaua"))

    @functools.cache
    def rest(i, initials, inserted):
        options = []
        if i == len(rows) and shape.fullmatch(initials):
            options.append((0, "", ()))

        def go(edit, cost, j, role, text, count):
            told = () if role is None else (f"{role}:{text}",)
            now = initials if role is None else initials + role[:1]
            if not viable(now):
                return
            now = "ua" if now.endswith("a") else "u" if now.endswith("u") else now
            found = rest(j, now, count)
            if found is not None:
                options.append((cost + found[0], edit + found[1], told + found[2]))

        if inserted < 2:
            for role in ("user", "assistant"):
                go("I", 2, i, role, "", inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go("D", 3, i + 1, None, None, 0)
            if fault not in (1, 2):
                more = 1 if fault == 3 else 0
                go("K", more, i + 1, role, text, 0) if role[:1] in ("s", "u", "a") else None
                for given in ("user", "assistant"):
                    go("R", 2 + more, i + 1, given, text, 0)
        return min(options, key=lambda o: o[:2]) if options else None

    return rest(0, "", 0)


def plain(rows):
    """Results by conversation; ``rows``: (conv_id, turn, role, text)."""
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, found in grouped.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, told, faults = set(), [], [0, 0, 0, 0]
        for _, role, text in found:
            bare = text.strip(" \t\n\v\f\r")
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            told.append((role, text, fault))
        turns = {t for t, _, _ in found if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(found))
        cost, audit, lines = cheapest(told)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults[1:], illegal, cost, audit, digest, lines)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", "z", "w") for row in rows], EXTRA).repartition(3)


def compare(spark, rows, **options):
    found = c.repair(frame(spark, rows), **options)
    assert found.columns == ["conv_id", *ORDINARY]
    expected = plain(rows)
    assert {r.conv_id: tuple(r[1:]) for r in found.collect()} == {conv: row[:-1] for conv, row in expected.items()}
    turns = defaultdict(list)
    for r in c.repaired_turns(frame(spark, rows), found).collect():
        turns[r.conv_id].append((r.place, f"{r.role}:{r.text}"))
    lines = {conv: tuple(line for _, line in sorted(told)) for conv, told in turns.items()}
    assert lines == {conv: row[-1] for conv, row in expected.items() if row[-1]}
    assert all(sorted(p for p, _ in told) == list(range(len(told))) for told in turns.values())


ROLES = ["user", "assistant", "system", "tool", "uncle", "", None, "Söhne", "süß"]
TEXTS = ["Hello.", "Hello", "Why?", "Go!", "", " \t\n", None, "no end", "end. \n", "é", ".", "\x1f", "a:b\nc."]


def test_random_conversations(spark):
    rng, rows = random.Random(3), []
    for conv in [None, *range(300)]:
        weights = rng.choice([[6, 6, 2, 1, 1, 1, 1, 1, 1], [1] * 9, [9, 9, 0, 0, 0, 0, 0, 0, 0], [1, 1, 1, 9, 0, 0, 0, 0, 0]])
        for _ in range(rng.randint(1, 9)):
            turn = rng.choice([None, *range(8)])
            rows.append((conv, turn, rng.choices(ROLES, weights)[0], rng.choice(TEXTS)))
    compare(spark, rows)


def test_alternating_conversations_with_single_faults(spark):
    """Long stretches in order, so that most turns are kept."""
    rng, rows = random.Random(4), []
    for conv in range(120):
        told = [("system", "Be kind.")] * rng.randint(0, 1) + [("user", "Q?"), ("assistant", "A.")] * rng.randint(1, 5)
        told = [(role, f"{i} {text}") for i, (role, text) in enumerate(told)]
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(told))
            role, text = told[at]
            told[at : at + 1] = rng.choice([[], [(role, "")], [(role, text)] * 2, [("user", text)], [(role, text[:-1])]])
            if not told:
                break
        rows += [(conv, turn, role, text) for turn, (role, text) in enumerate(told)]
    compare(spark, rows)


@pytest.mark.parametrize("roles", [["tool"], ["user"], ["assistant", "assistant", "user"], ["system"]])
def test_trail_in_a_file_and_many_batches(spark, roles):
    """One conversation over many Arrow batches, its backpointers in a file of many parts."""
    rows = [(1, i // 2, roles[i % len(roles)], f"{i}." if i % 7 else f"{i}") for i in range(700)]
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        found = {r.conv_id: r for r in c.repair(frame(spark, rows), trail_rows=5).collect()}
        expected = {r.conv_id: r for r in c.repair(frame(spark, rows)).collect()}
        assert found == expected and found[2].audit == "KK" and found[2].cost == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # the least cost by a plain recurrence over whole conversations
    costs = {0: 0, 2: 2, 3: 4}
    for _, turn, role, text in sorted(rows[:700], key=lambda r: (r[1], r[2], r[3])):
        more, nxt = 0 if text[-1] == "." else 1, {}
        for q, cost in costs.items():
            for to, own in ((q, 3), (c._after(q), 2 + more), (c.KEPT.get((q, role[:1])), more)):
                if to is not None:
                    nxt[to] = min(nxt.get(to, 10**9), cost + own)
        for _ in range(3):
            for q, cost in list(nxt.items()):
                nxt[c._after(q)] = min(nxt.get(c._after(q), 10**9), cost + 2)
        costs = nxt
    assert found[1].cost == min(costs[q] for q in (0, 3) if q in costs)


def test_the_worst_state_is_bounded():
    """No state's cost to the end exceeds another's by more than the bound."""
    symbols = [(i, f) for i in ("s", "u", "a", "t") for f in (0, 3)] + [("u", 1)]
    rng = random.Random(1)
    for _ in range(300):
        togo = [0, 4, 2, 0]
        for initial, fault in rng.choices(symbols, k=rng.randint(0, 12)):
            more = 1 if fault == 3 else 0
            nxt = [3 + togo[q] for q in range(4)]
            if fault != 1:
                for q in range(4):
                    nxt[q] = min(nxt[q], 2 + more + togo[c._after(q)])
                    if (q, initial) in c.KEPT:
                        nxt[q] = min(nxt[q], more + togo[c.KEPT[q, initial]])
            for _ in range(3):
                nxt = [min(nxt[q], 2 + nxt[c._after(q)]) for q in range(4)]
            togo = nxt
            assert max(togo) - min(togo) <= c.WORST_STATE


def test_reported_ids_and_no_rows(spark):
    none = spark.createDataFrame([], EXTRA)
    assert c.repair(none).count() == 0 and c.repaired_turns(none, c.repair(none)).count() == 0
    also = spark.createDataFrame([(1,), (1,), (None,), (2,)], "conv_id bigint")
    found = {r.conv_id: r for r in c.repair(frame(spark, [(2, 0, "user", "a.")]), also=also).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found.keys() == {1, 2, None} and tuple(found[1])[1:] == tuple(found[None])[1:] == empty and found[2].audit == "KI"


def drill(rows):
    left, ids = [], set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        left += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return left, ids


def test_query_equals_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left, ids = drill(rows)
    expected = {conv: row[:-1] for conv, row in plain(left).items()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = queries.QUERIES["op13_conversations"](spark, SF).collect()
    assert {r.conv_id: tuple(r[1:]) for r in found} == {conv: expected.get(conv, empty) for conv in ids} and len(found) == len(ids)


def test_drill_of_nulls(spark):
    rows = [(None, None, None, None), (1, None, "user", None), (None, 3, None, "a."), *[(i, i % 5, "system", "Is it? Yes.") for i in range(200)]]
    left, dropped = c.damaged(frame(spark, rows))
    expected, ids = drill(rows)
    assert sorted(map(str, left.collect())) == sorted(map(str, spark.createDataFrame(expected, "conv_id long, turn long, role string, text string").collect()))
    assert {r.conv_id for r in dropped.collect()} >= ids - {row[0] for row in expected}


def test_query_equals_sql(spark):
    found = queries.QUERIES["op13_conversations"](spark, SF)
    assert oracle.difference(found, oracle.connect(SF), queries.SQL["op13_conversations"]) is None
