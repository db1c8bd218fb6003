"""Suffix order of a shard by external induced sorting, with common-prefix lengths.

Suffixes are smaller (S) or larger (L) than the suffix one symbol later. The
S suffixes that follow an L suffix are sorted first, by recursion on their names;
they induce the order of the L suffixes, and these that of all S suffixes. The
tuples of induced suffixes wait in a priority queue whose ranges of symbols lie
on disk beyond a memory limit, and each carries the length of the prefix that
it shares with the tuple before it.
"""

from __future__ import annotations

import tempfile

import numpy as np

# Tuples that the queue keeps in memory, and symbols ranges' aimed-at tuples.
MEMORY_TUPLES = 1 << 21
RANGE_TUPLES = 1 << 16


class RangeQueue:
    """Tuples ``(symbol, position, prefix)`` by range of symbols, first in first out within a symbol.

    Ranges are taken out in ascending order. What exceeds ``memory`` tuples is
    appended to one anonymous file of the task, which goes when the queue does:
    a lost task leaves nothing behind and starts anew.
    """

    def __init__(self, bounds: np.ndarray, memory: int) -> None:
        self.bounds, self.memory, self.held = bounds, memory, 0
        self.parts: dict[int, list] = {}
        self.file = None

    def push(self, symbols: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        where = np.searchsorted(self.bounds, symbols, side="right") - 1
        order = np.argsort(where, kind="stable")
        cuts = np.flatnonzero(np.diff(where[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                rows = np.stack([symbols[part], positions[part], prefixes[part]])
                self.parts.setdefault(int(where[part[0]]), []).append(rows)
                self.held += len(part)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for held in self.parts.values():
            for i, rows in enumerate(held):
                if isinstance(rows, np.ndarray):
                    held[i] = (self.file.seek(0, 2), rows.shape[1])
                    self.file.write(np.ascontiguousarray(rows).tobytes())
        self.held = 0

    def pop(self, number: int) -> np.ndarray:
        found = [np.zeros((3, 0), dtype=np.int64)]
        for rows in self.parts.pop(number, []):
            if isinstance(rows, tuple):
                self.file.seek(rows[0])
                rows = np.frombuffer(self.file.read(24 * rows[1]), dtype=np.int64).reshape(3, rows[1])
            else:
                self.held -= rows.shape[1]
            found.append(rows)
        return np.concatenate(found, axis=1)


class _RangeMinimum:
    """Minimum of any interval of an array."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        size = 1
        while 2 * size <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-size], last[size:]))
            size *= 2

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima of [low, high], both within the array."""
        out = np.empty(len(low), dtype=np.int64)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return out


def _ranges(counts: np.ndarray, aim: int) -> np.ndarray:
    """First symbols of ranges with about ``aim`` tuples, one symbol at least."""
    total = np.cumsum(counts)
    bounds = [0]
    while total[-1] - (total[bounds[-1] - 1] if bounds[-1] else 0) > aim:
        start = total[bounds[-1] - 1] if bounds[-1] else 0
        nxt = max(bounds[-1] + 1, int(np.searchsorted(total, start + aim, side="right")))
        if nxt >= len(counts):
            break
        bounds.append(nxt)
    return np.array(bounds, dtype=np.int64)


def _shared_with_previous(symbols: np.ndarray, sources: np.ndarray, source_symbols: np.ndarray, low: _RangeMinimum) -> np.ndarray:
    """Common prefix of each induced suffix with the one before it in the same symbol,
    given in the order of their sources: one symbol and what the sources share."""
    order = np.argsort(symbols, kind="stable")
    s, f, c = symbols[order], sources[order], source_symbols[order]
    out = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        same = s[1:] == s[:-1]
        near = same & (c[1:] == c[:-1])
        shared = same.astype(np.int64)
        at = np.flatnonzero(near)
        shared[at] = 1 + low.of(f[at] + 1, f[at + 1])
        out[order[1:]] = shared
    return out


def _scan(text, induced, runs, seeds, seed_prefixes, memory: int, aim: int):
    """Suffixes in scan order with prefixes shared with the one before.

    ``seeds`` come in order; of every suffix scanned, the one a symbol earlier is
    put into the queue if ``induced`` marks it. Within a symbol the induced ones come first.
    """
    n_symbols = int(text.max()) + 1
    counts = np.bincount(text[induced], minlength=n_symbols) + np.bincount(text[seeds], minlength=n_symbols)
    bounds = _ranges(counts, aim)
    queue = RangeQueue(bounds, memory)
    seed_symbols = text[seeds]
    seed_cuts = np.searchsorted(seed_symbols, np.append(bounds, n_symbols))
    positions, prefixes = [], []
    for r in range(len(bounds)):
        symbol, position, prefix = queue.pop(r)
        own = slice(seed_cuts[r], seed_cuts[r + 1])
        stop = bounds[r + 1] if r + 1 < len(bounds) else n_symbols
        n_out = len(symbol)
        # kind 0: from other ranges, 1: from this range (in the order of their sources), 2: seeds
        inner = np.zeros((3, 0), dtype=np.int64)  # symbol, position, place of the source in scan order
        width = np.uint16 if stop - bounds[r] <= 1 << 16 else np.int64  # short symbols are sorted by radix
        while True:
            s = np.concatenate([symbol, inner[0], seed_symbols[own]])
            order = np.argsort((s - bounds[r]).astype(width), kind="stable")
            s = s[order]
            p = np.concatenate([position, inner[1], seeds[own]])[order]
            before = p - 1
            push = induced[before] & (p > 0)
            target = text[before]
            at = np.flatnonzero(push & (target < stop))
            if not len(at) and not inner.shape[1]:
                break
            new = np.stack([target[at], before[at], at])
            settled = new.shape == inner.shape and np.array_equal(new, inner)
            inner = new
            if settled:
                break
        kind = np.repeat([0, 1, 2], [n_out, inner.shape[1], len(seeds[own])])[order]
        rank = np.concatenate([np.zeros(n_out, np.int64), inner[2], np.zeros(len(seeds[own]), np.int64)])[order]
        # prefixes: carried, read from the seeds, or from the sources in this range
        shared = np.zeros(len(s), dtype=np.int64)
        same = np.concatenate([[False], s[1:] == s[:-1]]) if len(s) else np.zeros(0, dtype=bool)
        carried = np.concatenate([prefix, np.zeros(inner.shape[1], np.int64), seed_prefixes[own]])[order]
        earlier_kind = np.concatenate([[-1], kind[:-1]]) if len(s) else kind
        shared[same] = np.maximum(carried[same], 1)  # sources of different ranges share nothing
        edge = np.flatnonzero(same & (kind == 2) & (earlier_kind < 2))
        shared[edge] = np.minimum(runs[p[edge]], runs[p[edge - 1]])
        mixed = np.flatnonzero(same & (kind == 1) & (earlier_kind == 0))
        shared[mixed] = 1
        chained = np.flatnonzero(same & (kind == 1) & (earlier_kind == 1))
        if len(chained):
            source, previous = rank[chained], rank[chained - 1]
            near = s[source] == s[previous]
            shared[chained] = 1
            chained, source, previous = chained[near], source[near], previous[near]
            while len(chained):  # sources stand before what they induce, so this settles
                value = 1 + _RangeMinimum(shared).of(previous + 1, source)
                if np.array_equal(value, shared[chained]):
                    break
                shared[chained] = value
        out = np.flatnonzero(push & (target >= stop))
        if len(out):
            targets = target[out]
            queue.push(targets, before[out], _shared_with_previous(targets, out, s[out], _RangeMinimum(shared)))
        positions.append(p)
        prefixes.append(shared)
    return np.concatenate(positions), np.concatenate(prefixes)


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is S, and how often its first symbol repeats at its start."""
    n = len(text)
    end = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    length = np.diff(end, prepend=-1)
    larger = np.append(text[end[1:]] > text[end[:-1]], True)  # than the symbols of the run before
    left = np.repeat(end + 1, length) - np.arange(n)
    return np.repeat(larger, length), left


def _names(text: np.ndarray, small: np.ndarray, stars: np.ndarray) -> tuple[np.ndarray, bool]:
    """Rank of each star substring (up to and with the next star), and whether all differ."""
    code = text.astype(np.uint64) * np.uint64(2) + small.astype(np.uint64) + np.uint64(1)
    bits = int(code.max()).bit_length()
    width = max(1, 63 // bits)
    last = np.append(stars[1:], stars[-1])
    base = np.zeros(len(stars), dtype=np.int64)
    active, offset = np.arange(len(stars)), 0
    while len(active):
        key = np.zeros(len(active), dtype=np.uint64)
        for j in range(offset, offset + width):
            at = stars[active] + j
            key = (key << np.uint64(bits)) | np.where(at <= last[active], code[np.minimum(at, len(text) - 1)], np.uint64(0))
        order = np.lexsort((key, base[active]))
        b, k = base[active][order], key[order]
        fresh = np.concatenate([[True], (b[1:] != b[:-1]) | (k[1:] != k[:-1])])
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        # a class keeps its place; its parts follow each other within it
        place = np.concatenate([[True], b[1:] != b[:-1]])
        start = np.maximum.accumulate(np.where(place, np.arange(len(b)), 0))
        base[active[order]] = b + first[group] - start
        size = np.diff(np.append(first, len(b)))[group]
        offset += width
        active = active[order][(size > 1) & (stars[active[order]] + offset <= last[active[order]])]
    ranks = np.unique(base, return_inverse=True)
    return ranks[1].astype(np.int32), len(ranks[0]) == len(stars)


def _extend(text: np.ndarray, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Lengthen known common prefixes of suffix pairs to their full length."""
    n, shared = len(text), shared.copy()
    active = np.arange(len(a))
    while len(active):
        x, y = a[active] + shared[active], b[active] + shared[active]
        inside = (x < n) & (y < n)
        equal = inside & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])
        active = active[equal]
        shared[active] += 1
    return shared


def suffix_order(text: np.ndarray, memory: int = MEMORY_TUPLES, aim: int = RANGE_TUPLES) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes of ``text`` and the prefix each shares with the one before it.

    ``text`` holds integers from 1 and ends with its only 0.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    small, runs = _types(text)
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    names, distinct = _names(text, small, stars)
    if distinct:
        order, common = np.argsort(names), np.zeros(len(stars), dtype=np.int64)
    else:
        order, common = suffix_order(names, memory, aim)
    sorted_stars = stars[order]
    # names in common are text in common up to the star where the names part
    known = np.zeros(len(order), dtype=np.int64)
    known[1:] = stars[np.minimum(order[1:] + common[1:], len(stars) - 1)] - stars[order[1:]]
    prefixes = np.zeros(len(order), dtype=np.int64)
    prefixes[1:] = _extend(text, sorted_stars[:-1], sorted_stars[1:], known[1:])

    found, shared = _scan(text, ~small, runs, sorted_stars, prefixes, memory, aim)
    large = ~small[found]
    # neighbours among the L suffixes of one symbol are neighbours in the scan
    seeds, shared = found[large], shared[large]
    # the same scan from the other end induces the S suffixes
    mirrored = int(text.max()) - text
    back = np.append(shared[1:], 0)[::-1]
    induced = small.copy()
    induced[n - 1] = False
    found, shared = _scan(mirrored, induced, runs, seeds[::-1], back, memory, aim)
    # the end of the text, smallest of all, has no suffix after it and is not induced
    order = np.concatenate([[n - 1], found[::-1]])
    prefix = np.zeros(n, dtype=np.int64)
    prefix[2:] = shared[::-1][:-1]
    return order, prefix
