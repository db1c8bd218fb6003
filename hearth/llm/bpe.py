"""Token ids by the tokenizers library, a block of texts at a time.

A block is cut into units (a word with the blank before it), distinct units into
pieces (letters and what follows them); each distinct piece is encoded once, and the
ids of the texts are gathered from those of their units and pieces.

Meant for tokenizer files that split texts as byte-level BPE does, with no added
token that holds a blank.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text in a block, and of the pieces that a worker remembers between blocks.
BLOCK_BYTES = 3 << 20
CACHE_BYTES = 16 << 20
CACHED_PIECE_BYTES = 64
# Pieces per call of the library: one string, one result.
JOINED = 512

# White space by any definition, but for space and newline.
_OTHER_BLANKS = "\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANKS = f" \n{_OTHER_BLANKS}"
_MARK = "\x01"
# Texts whose blanks are all single spaces and newlines (and without the mark)
# are split by Arrow; others by the expression below, where only a blank that
# stands alone between two other characters is a border.
_AWKWARD = f"[ \n][ \n]|[{_OTHER_BLANKS}{_MARK}]"
_BORDER = re.compile(f"(?<=[^{_BLANKS}])(?= [^{_BLANKS}])|(?<=[^{_BLANKS}])(?=\n[^{_BLANKS}])|(?<=[^{_BLANKS}]\n)(?=[^{_BLANKS}])")
# Within a unit the place between a letter and such a mark is a border too.
_SPELLING = r"(\pL)([!-&(-/:-@\[-`{-~])"
# Between two newlines such a piece of a unit is encoded as it is anywhere else.
_JOINABLE = f"^ ?[^{_BLANKS}]+$"


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


class Pieces:
    """Ids of pieces met before, bounded in bytes; beyond that those met in few blocks go."""

    def __init__(self, bound: int = CACHE_BYTES) -> None:
        self.bound = bound
        self.texts = pa.array([], pa.string())
        self.ids = np.empty(0, np.uint32)
        self.lengths = np.empty(0, np.int64)
        self.blocks = np.empty(0, np.int64)

    def nbytes(self) -> int:
        return self.texts.nbytes + self.ids.nbytes + self.lengths.nbytes + self.blocks.nbytes

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Position of each piece, or -1."""
        places = pc.fill_null(pc.index_in(pieces, value_set=self.texts), -1).to_numpy(zero_copy_only=False)
        self.blocks[places[places >= 0]] += 1
        return places

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of the pieces at ``places``."""
        lengths = self.lengths[places]
        return ragged(self.ids, _starts(self.lengths)[places], lengths), lengths

    def add(self, pieces: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        short = pc.less_equal(pc.binary_length(pieces), CACHED_PIECE_BYTES).to_numpy(zero_copy_only=False)
        ids = ids[np.repeat(short, lengths)]
        self.texts = pa.concat_arrays([self.texts, pieces.filter(pa.array(short))])
        self.ids = np.concatenate([self.ids, ids])
        self.lengths = np.concatenate([self.lengths, lengths[short]])
        self.blocks = np.concatenate([self.blocks, np.ones(short.sum(), np.int64)])
        if self.nbytes() > self.bound:
            self._halve()

    def _halve(self) -> None:
        """Keep the pieces of most blocks, in half of the bound."""
        order = np.argsort(-self.blocks, kind="stable")
        sizes = pc.binary_length(self.texts).to_numpy(zero_copy_only=False) + 4 * self.lengths + 20
        kept = np.sort(order[np.cumsum(sizes[order]) <= self.bound // 2])
        self.ids, lengths = self.take(kept)
        self.texts, self.lengths, self.blocks = self.texts.take(pa.array(kept)), lengths, np.maximum(self.blocks[kept] // 2, 1)


class Encoder:
    """Encodes blocks of texts with one tokenizer file."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._newline = self._library(["\n"])[0]
        self._known = Pieces(cache_bytes)
        added = [re.escape(one.content) for one in self._tokenizer.get_added_tokens_decoder().values()]
        self._uncut = "|".join([_MARK, *added])

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(one.ids, np.uint32) for one in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of joinable pieces, encoded as lines of one string."""
        ids = self._library(["\n".join(pieces)])[0]
        breaks = np.flatnonzero(ids == self._newline[0]) if len(self._newline) == 1 else np.empty(0, np.int64)
        if len(breaks) != len(pieces) - 1:  # a vocabulary with tokens across newlines, or the token of one within a piece
            each = self._library(pieces)
            return np.concatenate(each), np.array([len(one) for one in each], np.int64)
        return np.delete(ids, breaks), np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of distinct pieces."""
        joinable = pc.match_substring_regex(pieces, _JOINABLE).to_numpy(zero_copy_only=False)
        texts = np.array(pieces.to_pylist(), dtype=object)
        lengths, parts = np.zeros(len(pieces), np.int64), []
        places = np.flatnonzero(joinable)
        for at in range(0, len(places), JOINED):
            some = places[at : at + JOINED]
            ids, lengths[some] = self._joined(list(texts[some]))
            parts.append(ids)
        rest = np.flatnonzero(~joinable)
        each = self._library(list(texts[rest]))
        lengths[rest] = [len(one) for one in each]
        ids = np.concatenate([*parts, *each, np.empty(0, np.uint32)])
        order = np.concatenate([places, rest])
        starts = np.empty(len(pieces), np.int64)
        starts[order] = _starts(lengths[order])
        return ragged(ids, starts, lengths), lengths

    def _pieces_of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of units by their pieces."""
        lists = pc.split_pattern(pc.replace_substring_regex(units, _SPELLING, f"\\1{_MARK}\\2"), _MARK)
        coded = lists.flatten().dictionary_encode()
        ids, starts, lengths = self._known_or_encoded(coded.dictionary)
        places = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[places])])
        return ragged(ids, starts[places], lengths[places]), np.diff(ends[lists.offsets.to_numpy()])

    def _ids_of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and starts and lengths of the distinct units."""
        whole = pc.match_substring_regex(units, self._uncut).to_numpy(zero_copy_only=False)
        ids, own = self._pieces_of(units.filter(pa.array(~whole)))
        each = self._library(units.filter(pa.array(whole)).to_pylist())
        lengths = np.empty(len(units), np.int64)
        lengths[~whole], lengths[whole] = own, [len(one) for one in each]
        starts = np.empty(len(units), np.int64)
        starts[~whole], starts[whole] = _starts(own), len(ids) + _starts(lengths[whole])
        return np.concatenate([ids, *each]), starts, lengths

    def _known_or_encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and starts and lengths of distinct pieces."""
        places = self._known.find(pieces)
        known = places >= 0
        old_ids, old_lengths = self._known.take(places[known])
        new = pieces.filter(pa.array(~known))
        new_ids, new_lengths = self._encode(new)
        lengths = np.empty(len(pieces), np.int64)
        lengths[known], lengths[~known] = old_lengths, new_lengths
        starts = np.empty(len(pieces), np.int64)
        starts[known], starts[~known] = _starts(old_lengths), len(old_ids) + _starts(new_lengths)
        self._known.add(new, new_ids, new_lengths)
        return np.concatenate([old_ids, new_ids]), starts, lengths

    def _units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Units of all texts, and how many each text has."""
        awkward = pc.match_substring_regex(texts, _AWKWARD)
        plain = texts.filter(pc.invert(awkward))
        marked = pc.replace_substring(pc.replace_substring(plain, "\n", f"{_MARK}\n{_MARK}"), " ", f"{_MARK} ")
        lists = pc.split_pattern(marked, _MARK)
        if not pc.any(awkward).as_py():
            return lists.flatten(), np.diff(lists.offsets.to_numpy())
        split = pa.array([_BORDER.split(one) for one in texts.filter(awkward).to_pylist()], pa.list_(pa.string()))
        order = np.argsort(awkward.to_numpy(zero_copy_only=False), kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        both = pa.concat_arrays([lists, split]).take(pa.array(back))
        return both.flatten(), np.diff(both.offsets.to_numpy())

    def _counted(self, texts: pa.Array):
        units, counts = self._units(texts)
        coded = units.dictionary_encode()
        ids, starts, lengths = self._ids_of(coded.dictionary)
        places = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[places])])
        borders = np.concatenate([[0], np.cumsum(counts)])
        return ids, starts, lengths, places, np.diff(ends[borders])

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return self._counted(texts)[-1]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, as unsigned 32-bit, and their number in each."""
        ids, starts, lengths, places, counts = self._counted(texts)
        return ragged(ids, starts[places], lengths[places]), counts


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    return Encoder(path)


def _cut(text: str, size: int) -> list[str]:
    """Parts of about ``size`` characters, whose ids one after the other are those of the text."""
    parts, begin = [], 0
    while len(text) - begin > size and (border := _BORDER.search(text, begin + size)):
        parts.append(text[begin : border.start()])
        begin = border.start()
    return [*parts, text[begin:]]


def in_blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, int]]:
    """Consecutive texts of at most about ``size`` bytes, and how many rows end in each block.

    A longer text makes several blocks, all but the last of them with no row; one
    without a border between words stays whole.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    texts, begin, total = pc.fill_null(texts, ""), 0, 0
    for place, own in enumerate(sizes):
        if total and total + own > size:
            yield texts.slice(begin, place - begin), place - begin
            begin, total = place, 0
        if own > size:
            *parts, last = _cut(texts[place].as_py(), size)
            for part in parts:
                yield pa.array([part], pa.string()), 0
            yield pa.array([last], pa.string()), 1
            begin, total = place + 1, 0
        else:
            total += int(own)
    if begin < len(texts):
        yield texts.slice(begin), len(texts) - begin


def counts_of(one: Encoder, texts: pa.Array) -> np.ndarray:
    """Number of ids of each text, nulls as empty."""
    counts, open_ = [], 0
    for block, rows in in_blocks(texts):
        found = one.count(block)
        if rows:
            found[0] += open_
            counts.append(found)
        open_ = 0 if rows else open_ + int(found[0])
    return np.concatenate(counts) if counts else np.empty(0, np.int64)
