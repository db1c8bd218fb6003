"""Repair of conversation structure: the cheapest edits that make turns alternate.

Rows are dealt by conversation and sorted by turn; one pass carries the state of a
dynamic programme over Arrow batches. A conversation of any length needs the state,
four bytes a row of backpointers, which go to a file once there are many, and its
list of edits, which is a value of the result. Texts are read once and not kept.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Roles by initial, and the roles that edits may give.
USER, ASSISTANT = "user", "assistant"

# Where a repaired conversation stands: nothing yet, or the role initial last seen.
START, SYSTEM_SEEN, USER_SEEN, ASSISTANT_SEEN = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT_SEEN)
KEPT = {
    (START, "s"): SYSTEM_SEEN, (START, "u"): USER_SEEN, (SYSTEM_SEEN, "u"): USER_SEEN, (USER_SEEN, "a"): ASSISTANT_SEEN,
    (ASSISTANT_SEEN, "u"): USER_SEEN,
}
# The role that may come next, and is therefore what an edit gives.
GIVEN = {START: USER, SYSTEM_SEEN: USER, USER_SEEN: ASSISTANT, ASSISTANT_SEEN: USER}
LEGAL_PAIRS = {"su", "ua", "au"}

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
# What standing in the wrong state can cost at most: a close (I), and an 's' row
# that cannot be kept (D). A state behind by more than that never catches up.
WORST_STATE = INSERT_COST + DELETE_COST

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
BLANKS = " \t\n\x0b\x0c\r"
# Backpointers of one conversation that stay in memory.
TRAIL_ROWS = 1 << 18


def _after(state: int) -> int:
    return USER_SEEN if GIVEN[state] == USER else ASSISTANT_SEEN


@dataclass(frozen=True)
class Level:
    """The best edits of the rows so far, by the state they lead to.

    ``best[q]`` is (cost above the least, s, k): the edits that end with a row's own
    edit in state s, then k insertions; None if they cannot be part of the answer.
    ``order`` lists those s by their edits, ASCII-least first. Edits that end with
    different rows' edits of equal number of rows never begin one another, so this
    order holds whatever follows.
    """

    best: tuple
    order: tuple


def _level(ends: dict[int, tuple[int, str]]) -> tuple[Level, int]:
    """Close states under insertion; ``ends`` by state: cost and a key that sorts as the edits do."""
    order = sorted(ends, key=lambda s: ends[s][1])
    best: list = [None] * 4
    for s in order:
        cost, state = ends[s][0], s
        for k in range(3):
            if best[state] is None or cost < best[state][0]:  # on equal cost the first in order stays
                best[state] = (cost, s, k)
            cost, state = cost + INSERT_COST, _after(state)
    least = min(b[0] for b in best if b)
    best = [(b[0] - least, b[1], b[2]) if b and b[0] - least <= WORST_STATE else None for b in best]
    used = {b[1] for b in best if b}
    return Level(tuple(best), tuple(s for s in order if s in used)), least


FIRST = _level({START: (0, "")})[0]


@dataclass(frozen=True)
class Step:
    """What one row does to a level: ``moves[s]`` = (state before, edit) of each used end."""

    before: Level
    after: Level
    cost: int
    moves: dict


def _step(level: Level, initial: str, fault: int) -> Step:
    ends: dict[int, tuple[int, tuple, tuple]] = {}
    for p, found in enumerate(level.best):
        if found is None:
            continue
        cost, s, k = found
        edits = [(DELETE, p, DELETE_COST)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            edits.append((REROLE, _after(p), REROLE_COST + more))
            if (p, initial) in KEPT:
                edits.append((KEEP, KEPT[p, initial], more))
        for edit, state, own in edits:
            one = (cost + own, (level.order.index(s), INSERT * k + edit), (p, edit))
            if state not in ends or one[:2] < ends[state][:2]:
                ends[state] = one
    after, least = _level({state: (cost, key) for state, (cost, key, _) in ends.items()})
    return Step(level, after, least, {s: ends[s][2] for s in after.order})


class Steps:
    """All steps met so far; there are few, as costs above the least are bounded."""

    def __init__(self) -> None:
        self.listed: list[Step] = []
        self._known: dict = {}

    def __call__(self, level: Level, initial: str, fault: int) -> int:
        key = (level, initial if initial in ("s", "u", "a") else "", fault)
        if key not in self._known:
            self._known[key] = len(self.listed)
            self.listed.append(_step(*key))
        return self._known[key]


class Trail:
    """Numbers of the steps of one conversation, read back from the last.

    Beyond ``rows`` of them the older ones go to an unnamed file of this task attempt,
    as Spark's own spills do; no other task reads it.
    """

    def __init__(self, rows: int = TRAIL_ROWS) -> None:
        self.rows, self.recent, self.file, self.spilled = rows, array("I"), None, 0

    def append(self, number: int) -> None:
        self.recent.append(number)
        if len(self.recent) >= self.rows:
            self.file = self.file or tempfile.TemporaryFile()
            self.recent.tofile(self.file)
            self.spilled += 1
            self.recent = array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.recent)
        for part in reversed(range(self.spilled)):
            self.file.seek(part * self.rows * self.recent.itemsize)
            some = array("I")
            some.fromfile(self.file, self.rows)
            yield from reversed(some)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Lines:
    """Running digest of lines joined by newlines."""

    def __init__(self, digest=None, begun: bool = False) -> None:
        self.digest, self.begun = digest or hashlib.sha256(), begun

    def copy(self) -> Lines:
        return Lines(self.digest.copy(), self.begun)

    def add(self, line: bytes) -> None:
        self.digest.update(b"\n" + line if self.begun else line)
        self.begun = True

    def insert(self, state: int, count: int) -> int:
        """``count`` empty turns after ``state``; the state they lead to."""
        for _ in range(count):
            self.add(f"{GIVEN[state]}:".encode())
            state = _after(state)
        return state


class Conversation:
    """State carried from row to row of one conversation."""

    def __init__(self, steps: Steps, trail_rows: int = TRAIL_ROWS) -> None:
        self.steps, self.trail = steps, Trail(trail_rows)
        self.level, self.cost, self.lines = FIRST, 0, {START: Lines()}
        self.faults, self.illegal, self.last = [0, 0, 0, 0], 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in LEGAL_PAIRS
        self.last = initial
        number = self.steps(self.level, initial, fault)
        step = self.steps.listed[number]
        self.trail.append(number)
        self.lines = self._lines(step, role, text)
        self.level, self.cost = step.after, self.cost + step.cost

    def _lines(self, step: Step, role: str, text: str) -> dict[int, Lines]:
        ends = {}
        for state, (p, edit) in step.moves.items():
            _, s, k = step.before.best[p]
            lines = self.lines[s].copy()
            lines.insert(s, k)
            if edit != DELETE:
                lines.add(f"{role if edit == KEEP else GIVEN[p]}:{text}".encode())
            ends[state] = lines
        return ends

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of the repaired lines."""
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        order = self.level.order
        cost, _, (s, k) = min(
            (b[0], (order.index(b[1]), b[2]), (b[1], b[2])) for q in ACCEPTED if (b := self.level.best[q]) is not None
        )
        lines = self.lines[s].copy()
        lines.insert(s, k)
        audit = bytearray(INSERT.encode() * k)
        for number in self.trail.backwards():
            step = self.steps.listed[number]
            p, edit = step.moves[s]
            audit += edit.encode()
            _, s, k = step.before.best[p]
            audit += INSERT.encode() * k
        self.trail.close()
        audit.reverse()
        return (gaps, *self.faults[1:], self.illegal, self.cost + cost, audit.decode(), lines.digest.hexdigest())


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_RESULT_NAMES = [part.split(" ")[0] for part in RESULT.split(", ")]


def _one_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def fault_of(text: Column, seen: Column) -> Column:
    """The first fault of a row: blank, seen before, or without an end of sentence; 0 for none."""
    stripped = F.rtrim(text, F.lit(BLANKS))
    return (
        F.when(stripped == "", BLANK)
        .when(seen, DUPLICATE)
        .when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(0)
    )


def _rows(conversations: DataFrame, also: DataFrame | None) -> DataFrame:
    """One kind of row for real turns and for ids that only have to be reported."""
    real = conversations.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        _one_space("role").alias("role"),
        _one_space("text").alias("text"),
        F.lit(True).alias("is_row"),
    )
    if also is None:
        return real
    named = also.select(F.col("conv_id").cast("string").alias("conv"))
    nothing = [F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(False).alias("is_row")]
    return real.unionByName(named.select("conv", *nothing))


def _back(found: DataFrame, conversations: DataFrame, *columns: str) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *columns)


def _key(value) -> str | None:
    return value if isinstance(value, str) else None


def repair(conversations: DataFrame, *, also: DataFrame | None = None, trail_rows: int = TRAIL_ROWS) -> DataFrame:
    """Per ``conv_id`` (null is one more id): its faults, the cheapest edits and their outcome.

    ``conversations`` has ``conv_id, turn, role, text``; ids (integers or strings) in
    ``also`` are reported even without rows, with zeros, no edits and no lines. Rows are
    taken by turn, nulls first, then role and text; a null role or text is one space,
    and repeated rows are duplicates. A row's fault is the first of: blank; role and text
    seen earlier in the conversation; no ``.!?`` at its end.

    ``audit`` lists edits in order: Keep (0), Rerole to user or assistant (2), Delete (3,
    which blank and duplicate rows need), Insert an empty turn (2), a truncated row that
    stays 1 more. Edits are the cheapest, then ASCII-least, that leave no turns, or user
    and assistant in turn after at most one system turn. ``cost`` is their cost,
    ``repaired_sha256`` the digest of the ``role:text`` lines they leave, and
    :func:`repaired_turns` gives those turns themselves. ``gaps`` counts turns missing
    between the least and greatest, ``illegal`` neighbours whose role initials cannot
    follow each other. Further columns are passed over; an empty table gives an empty result.

    One task reads a conversation from end to end, as the order of its rows demands,
    but holds none of it; what a row needs of others (seen earlier) comes from a window
    over the same partitioning.
    """
    rows = _rows(conversations, also).withColumn("h", F.xxhash64("text")).repartition("conv")
    earlier = Window.partitionBy("conv", "is_row", "role", "h", "text").orderBy(F.asc_nulls_first("turn"))
    ordered = rows.withColumn("seen", F.row_number().over(earlier) > 1).sortWithinPartitions(
        "conv", "is_row", F.asc_nulls_first("turn"), "role", "text"
    )
    told = ordered.select(
        "conv",
        "is_row",
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        "role",
        "text",
        fault_of(F.col("text"), F.col("seen")).alias("fault"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, current, state = Steps(), None, None
        for batch in batches:
            done = []
            for conv, is_row, has_turn, turn, role, text, fault in zip(*[batch[name].tolist() for name in batch.columns], strict=True):
                conv = _key(conv)
                if state is None or conv != current:
                    if state is not None:
                        done.append((current, *state.result()))
                    current, state = conv, Conversation(steps, trail_rows)
                if is_row:
                    state.add(turn if has_turn else None, role, text, fault)
            yield pd.DataFrame(done, columns=["conv", *_RESULT_NAMES])
        if state is not None:
            yield pd.DataFrame([(current, *state.result())], columns=["conv", *_RESULT_NAMES])

    return _back(told.mapInPandas(run, f"conv string, {RESULT}"), conversations, *_RESULT_NAMES)


def repaired_turns(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """The turns that the edits leave: ``conv_id, place`` (from 0), ``edit, turn, role, text``.

    ``repaired`` is what :func:`repair` gave for these rows; inserted turns have no turn
    number. Again one sorted pass, in which a conversation's edits come before its rows.
    """
    edits = repaired.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(False).alias("is_row"),
    )
    rows = _rows(conversations, None).unionByName(edits).repartition("conv")
    ordered = rows.sortWithinPartitions("conv", "is_row", F.asc_nulls_first("turn"), "role", "text").select(
        "conv", "is_row", F.col("turn").cast("string").alias("turn"), "role", "text"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv", "place", "edit", "turn", "role", "text"]
        current = state = place = at = None
        audit = ""
        for batch in batches:
            out = []

            def inserted() -> None:
                nonlocal at, state, place
                while at < len(audit) and audit[at] == INSERT:
                    out.append((current, place, INSERT, None, GIVEN[state], ""))
                    at, state, place = at + 1, _after(state), place + 1

            for conv, is_row, turn, role, text in zip(*[batch[name].tolist() for name in batch.columns], strict=True):
                if not is_row:  # a conversation begins with its edits
                    current, audit, at, state, place = _key(conv), text, 0, START, 0
                    inserted()
                    continue
                edit = audit[at]
                at += 1
                if edit != DELETE:
                    role = role if edit == KEEP else GIVEN[state]
                    state = KEPT[state, role[:1]]
                    out.append((current, place, edit, _key(turn), role, text))
                    place += 1
                inserted()
            yield pd.DataFrame(out, columns=names)

    found = ordered.mapInPandas(run, "conv string, place bigint, edit string, turn string, role string, text string")
    return _back(found.withColumn("turn", F.col("turn").cast("bigint")), conversations, "place", "edit", "turn", "role", "text")


def damaged(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A drill: rows broken in ways that their id and turn decide, and the ids of dropped rows.

    Of twenty values of ``crc32(conv_id:turn) % 20``, 0 drops the row, 1 empties its
    text, 2 takes out its sentence ends, 3 repeats it, 4 makes its role ``user``. Nulls
    are one space before that, an id's or turn's only within the checksum.
    """
    code = F.crc32(F.encode(F.concat(_one_space("conv_id"), F.lit(":"), _one_space("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", _one_space("role").alias("role"), _one_space("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, USER).otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1)))
    left = rows.filter("code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
    return left.drop("copy"), rows.filter("code = 0").select("conv_id")
