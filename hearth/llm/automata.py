"""Probabilistic automata of string formats, by merging states of a prefix tree.

A state predicts the next character; its edges are by character class, so that random
parts do not branch by every character while fixed parts still predict theirs. Two
states are compatible if the characters seen at them, and at all that follows them, are
likelier to come from one distribution than from two. The prior of a distribution is a
mixture of two Dirichlet ones, for fixed and for random places: a few strings suffice where
characters are fixed, and states seen once or twice join where their characters fit best. Lengths are learned beside the states, as merged loops would
forget them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

# Characters a credential can have, and the weight of each in the two priors of a state,
# which are equally likely: few characters, or any.
ALPHABET = 67
PRIORS = (0.05, 1.0)
# What one more state costs: a merge that loses less than that is made.
STATE_COST = 6.0
# A longer string teaches its length and its first characters.
TAUGHT_CHARS = 512
# How far a merge may fall behind before its comparison ends.
HOPELESS = -40.0


def symbol(char: str) -> str:
    """Character classes: digits, hexadecimal and other letters by case; other characters stand for themselves."""
    if char.isascii() and char.isalnum():
        if char.isdigit():
            return "0"
        return ("a" if char <= "f" else "g") if char.islower() else ("A" if char <= "F" else "G")
    return char


@dataclass(eq=False)
class State:
    arrivals: int = 0
    counts: Counter = field(default_factory=Counter)
    next: dict[str, State] = field(default_factory=dict)


def prefix_tree(strings: Sequence[str]) -> State:
    root = State()
    for text in strings:
        state = root
        for char in text[:TAUGHT_CHARS]:
            state.arrivals += 1
            state.counts[char] += 1
            state = state.next.setdefault(symbol(char), State())
    return root


def _mixed(one: float, two: float) -> float:
    high, low = max(one, two), min(one, two)
    return high + math.log1p(math.exp(low - high)) - math.log(2)


def _more(prior: float, counts: Counter, arrivals: int, new: Counter, new_arrivals: int) -> float:
    """Logarithm of the probability of ``new`` characters after ``counts``, under one prior."""
    total = math.lgamma(ALPHABET * prior + arrivals) - math.lgamma(ALPHABET * prior + arrivals + new_arrivals)
    return total + sum(math.lgamma(prior + counts[c] + n) - math.lgamma(prior + counts[c]) for c, n in new.items())


_NONE: Counter = Counter()


def evidences(state: State) -> tuple[float, float]:
    """Logarithm of the probability of a state's characters under each prior."""
    return tuple(_more(prior, _NONE, 0, state.counts, state.arrivals) for prior in PRIORS)


def gain(red: State, blue: State) -> float:
    """How much likelier all characters become if ``blue`` and the tree below it join ``red``."""
    pooled: dict[int, list] = {}
    total, waiting = 0.0, [(red, blue)]
    while waiting and total > HOPELESS:
        a, b = waiting.pop()
        if id(a) not in pooled:
            pooled[id(a)] = [Counter(a.counts), a.arrivals, *evidences(a)]
        own = pooled[id(a)]
        counts, arrivals, few, any_ = own
        own[2:] = [old + _more(prior, counts, arrivals, b.counts, b.arrivals) for prior, old in zip(PRIORS, (few, any_), strict=True)]
        total += _mixed(*own[2:]) - _mixed(few, any_) - _mixed(*evidences(b))
        counts.update(b.counts)
        own[1] += b.arrivals
        for s, child in b.next.items():
            if s in a.next and a.next[s] is not child:
                waiting.append((a.next[s], child))
    return total


def _fold(red: State, blue: State) -> None:
    """Add the tree below ``blue`` to ``red``."""
    waiting = [(red, blue)]
    while waiting:
        red, blue = waiting.pop()
        red.arrivals += blue.arrivals
        red.counts.update(blue.counts)
        for s, child in blue.next.items():
            if s in red.next:
                waiting.append((red.next[s], child))
            else:
                red.next[s] = child


@dataclass
class Automaton:
    """Next states and logarithms of probabilities by state and character (ASCII); state 0
    is the start, the last state is for what no state leads to: it is never left, and
    predicts what the strings have anywhere."""

    next: np.ndarray
    step: np.ndarray
    lengths: dict[int, int]
    strings: int

    @property
    def states(self) -> int:
        return len(self.next) - 1

    def length_log(self, length: int) -> float:
        """Logarithm of the probability of a length: as often as seen, and 1/(n(n+1)) once more for all."""
        return math.log((self.lengths.get(length, 0) + 1 / (length * (length + 1))) / (self.strings + 1))

    def log_likelihoods(self, strings: Sequence[str]) -> np.ndarray:
        """Natural logarithm of the probability of each ASCII string, none of them empty; all at once, place by place."""
        order = sorted(range(len(strings)), key=lambda i: -len(strings[i]))
        sizes = np.array([len(strings[i]) for i in order], np.int64)
        if not len(sizes):
            return np.empty(0)
        flat = np.frombuffer("".join(strings[i] for i in order).encode("ascii"), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state, total = np.zeros(len(order), np.int64), np.array([self.length_log(int(n)) for n in sizes])
        for place in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -place, side="left"))  # strings longer than place come first
            chars, now = flat[starts[:live] + place], state[:live]
            total[:live] += self.step[now, chars]
            state[:live] = self.next[now, chars]
        out = np.empty(len(order))
        out[order] = total
        return out


def _settled(strings: Sequence[str]) -> list[State]:
    """States of the merged tree, from the start outwards: the most visited frontier state
    joins the settled state that gains most by it (or loses least), or becomes settled itself."""
    settled = [prefix_tree(strings)]
    known = {id(settled[0])}
    while True:
        frontier = [(r, s) for r in settled for s in sorted(r.next) if id(r.next[s]) not in known]
        if not frontier:
            return settled
        parent, s = max(frontier, key=lambda e: e[0].next[e[1]].arrivals)
        blue = parent.next[s]
        best, red = max(((gain(red, blue), -i) for i, red in enumerate(settled)), default=(-1.0, 0))
        if best > -STATE_COST or not blue.arrivals:
            parent.next[s] = settled[-red]
            _fold(settled[-red], blue)
        else:
            settled.append(blue)
            known.add(id(blue))


def infer(strings: Sequence[str]) -> Automaton:
    """The automaton of strings of one format (or of a few)."""
    settled = _settled(strings)
    number = {id(state): i for i, state in enumerate(settled)}
    lost = len(settled)
    following = np.full((lost + 1, 128), lost, np.int64)
    step = np.empty((lost + 1, 128))
    everything = State()  # what the strings have anywhere, for places that no state leads to
    for state in settled:
        everything.counts.update(state.counts)
        everything.arrivals += state.arrivals
    for i, state in enumerate([*settled, everything]):
        few, any_ = evidences(state)
        weight = 1 / (1 + math.exp(min(700.0, any_ - few)))
        for code in range(128):
            char = chr(code)
            seen = [(state.counts.get(char, 0) + prior) / (state.arrivals + ALPHABET * prior) for prior in PRIORS]
            step[i, code] = math.log(weight * seen[0] + (1 - weight) * seen[1])
            if symbol(char) in state.next:
                following[i, code] = number[id(state.next[symbol(char)])]
    return Automaton(following, step, dict(Counter(len(text) for text in strings)), len(strings))
