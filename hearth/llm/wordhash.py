"""Words of many texts at once, hashed with numpy inside a task.

A word's hash is a polynomial over its bytes, taken as a difference of prefix
sums, so that all words of a block of texts are hashed in a few array steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SHINGLE = [_U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(outside: bytes) -> np.ndarray:
    """True for the bytes that belong to a word."""
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
            self.up = np.full(size, _BASE, dtype=np.uint64)
            self.down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up, self.down


_POWERS = _Powers()


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, a null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes, at least one text each."""
    begin = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield begin, i
            begin, total = i, 0
        total += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the byte polynomial (one more than bytes), and inverse powers."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)], out=sums[1:])
    return sums, down


@dataclass
class Words:
    """Words of a block of texts; ``first[d]`` to ``first[d + 1]`` are those of text d."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` consecutive words at each word, and whether they lie in one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            total += mix(self.hashes[j : j + n] + _U(j)) * _SHINGLE[j % len(_SHINGLE)] + _U(j // len(_SHINGLE))
        whole = np.ones(n, dtype=bool)
        for j in range(1, size):  # a text that begins inside ends the shingles before it
            cut = self.first[1:-1] - j
            whole[cut[(cut >= 0) & (cut < n)]] = False
        return mix(total + _U(size)), whole


def words_of(texts: list[bytes], inside: np.ndarray) -> Words:
    """Words of ``texts`` after lower-casing A-Z; ``inside`` must exclude the newline."""
    raw = b"\n".join(texts)
    data = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    member = np.zeros(len(data) + 2, dtype=np.int8)
    member[1:-1] = inside[data]
    edges = np.diff(member)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums, down = prefix_hash(data)
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return Words(data.tobytes(), starts, ends, hashes, np.searchsorted(starts, begins))
