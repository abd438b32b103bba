"""Cutting texts into the words of a tokenizer, a slice of documents at a time in arrays.

A slice is classified code point by code point with a table, word starts follow
from neighbouring classes, and Arrow gives every distinct word a number. What
costs time per word - the merges - is then paid once per distinct word.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docloom.llm.worker import once

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
_TIMES = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1_000_000
# What White_Space holds.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings cut off after an apostrophe.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
# Below U+0180 lower case is one to one and no sequence composes, but for U+0130.
UNUSUAL = re.compile("[^\x00-įı-ſ]")


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers whose bits all depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    table[WHITE] = SPACE
    table[0x20] = BLANK
    return table


def classes() -> np.ndarray:
    """The class of every code point."""
    return once(("classes",), _classes)


def slices(sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring documents with ``most`` characters or a single document each."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        end = max(end, at + 1)
        yield at, end
        at = end


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and where each text starts (one more entry than texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def _ending(points: np.ndarray, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The length of the ending after each apostrophe at ``at``, 0 for none; ``limit``: where its text ends."""
    found = np.zeros(len(at), np.int64)
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in ENDINGS:
        fits = (at + 1 + len(ending) <= limit) & (found == 0)
        for i, c in enumerate(ending):
            fits &= padded[at + 1 + i] == ord(c)
        found[fits] = len(ending)
    return found


def word_starts(points: np.ndarray, starts: np.ndarray, attach_blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where words start, and the class of each word's first code point.

    Words cover all code points. A word is a run of letters, of numbers, of white
    space or of anything else, or an ending with its apostrophe.
    ``attach_blank``: a blank before a run belongs to it, and white space
    before a run otherwise gives its last character a word of its own. Without
    it every number is a word of its own.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    kind = classes()[points]
    run = np.minimum(kind, SPACE)
    first = np.empty(n + 4, bool)
    first[0] = True
    np.not_equal(run[1:], run[:-1], out=first[1:n])
    first[n:] = True
    first[starts[:-1][starts[:-1] < n]] = True
    word = first.copy()
    if attach_blank:
        new_text = np.zeros(n, bool)
        new_text[starts[:-1][starts[:-1] < n]] = True
        after = np.flatnonzero(first[1:n] & (run[1:] != SPACE) & (run[:-1] == SPACE) & ~new_text[1:]) + 1
        word[after - 1] = True
        word[after[kind[after - 1] == BLANK]] = False
    else:
        word[:n] |= kind == NUMBER
    quote = np.flatnonzero((points == 0x27) & word[:n] & first[:n] & first[1 : n + 1])
    if len(quote):
        limit = starts[np.searchsorted(starts, quote, side="right")]
        size = _ending(points, quote, limit)
        quote, size = quote[size > 0], size[size > 0]
        word[quote + 1] = False
        word[quote + 1 + size] = True
    at = np.flatnonzero(word[:n])
    return at, kind[at]


def distinct_words(texts: list[str], attach_blank: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, place of each word among them, words before each text, code point of each word start).

    Without ``attach_blank`` white space is among the words.
    """
    points, starts = code_points(texts)
    at, _ = word_starts(points, starts, attach_blank)
    data = "".join(texts).encode("utf-8", "surrogatepass")
    if len(data) == len(points):
        ends = np.append(at, len(points))
    else:
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        ends = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(at, len(points))]
    words = pa.Array.from_buffers(
        pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    ).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.searchsorted(at, starts), at


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all items of lists that start at ``starts`` in one flat array, list after list."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits of each word of a binary array: a sum over its bytes with a multiplier for each place, mixed."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    size = np.diff(offsets)
    data = words.buffers()[2]
    letters = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    place = np.arange(len(letters)) - np.repeat(offsets[:-1] - offsets[0], size)
    factors = mixed(np.arange(1, int(size.max(initial=0)) + 1, dtype=np.uint64) * _TIMES) | np.uint64(1)
    parts = (letters.astype(np.uint64) + np.uint64(1)) * factors[place]
    ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts)])
    return mixed(ends[offsets[1:] - offsets[0]] - ends[offsets[:-1] - offsets[0]])


@dataclass
class Known:
    """Words by hash, in order, with a flat list of numbers each."""

    hashes: np.ndarray
    words: pa.Array
    start: np.ndarray
    size: np.ndarray
    flat: np.ndarray

    @classmethod
    def of(cls, words: pa.Array, hashes: np.ndarray, size: np.ndarray, flat: np.ndarray) -> Known:
        order = np.argsort(hashes, kind="stable")
        start = np.cumsum(size) - size
        return cls(hashes[order], words.take(pa.array(order)), start[order], size[order], flat)

    def with_(self, other: Known) -> Known:
        start = np.concatenate([self.start, other.start + len(self.flat)])
        hashes = np.concatenate([self.hashes, other.hashes])
        order = np.argsort(hashes, kind="stable")
        words = pa.concat_arrays([self.words, other.words]).take(pa.array(order))
        size = np.concatenate([self.size, other.size])[order]
        return Known(hashes[order], words, start[order], size, np.concatenate([self.flat, other.flat]))

    def find(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The place of each word here, -1 for none; bytes are compared where hashes agree."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        alike = np.flatnonzero(self.hashes[at] == hashes)
        same = pc.equal(self.words.take(pa.array(at[alike])), words.take(pa.array(alike)))
        place = np.full(len(hashes), -1)
        alike = alike[same.to_numpy(zero_copy_only=False)]
        place[alike] = at[alike]
        return place


class Numbers:
    """A flat list of numbers per word, made for unseen words only.

    Words lie in a few runs by hash; neighbouring runs of like size are merged, up to an eighth of ``most`` words, and
    beyond ``most`` the oldest run is dropped. Words and numbers lie in arrays, some forty bytes a word.
    """

    def __init__(self, make, most: int = 400_000):
        self.make, self.most = make, most
        self.runs: list[Known] = []

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, flat): word i has the numbers flat[start[i] : start[i] + size[i]]. Words are distinct."""
        hashes = word_hashes(words)
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        flat, held, rest = [], 0, np.arange(len(words))
        for run in self.runs:
            place = run.find(words.take(pa.array(rest)), hashes[rest])
            hit = rest[place >= 0]
            at = place[place >= 0]
            size[hit] = run.size[at]
            start[hit] = held + np.cumsum(run.size[at]) - run.size[at]
            flat.append(run.flat[ragged(run.start[at], run.size[at])])
            held, rest = held + len(flat[-1]), rest[place < 0]
        if len(rest):
            new = words.take(pa.array(rest))
            made, many = self.make(new.to_pylist())
            size[rest] = many
            start[rest] = held + np.cumsum(many) - many
            flat.append(made.astype(np.int32))
            self._add(Known.of(new, hashes[rest], many.astype(np.int64), flat[-1]))
        return start, size, np.concatenate(flat) if flat else np.empty(0, np.int32)

    def _add(self, run: Known) -> None:
        self.runs.append(run)
        while len(self.runs) > 1:
            one, two = self.runs[-2], self.runs[-1]
            both = len(one.hashes) + len(two.hashes)
            if both > max(self.most // 8, 1) or len(one.hashes) > 2 * len(two.hashes):
                break
            self.runs[-2:] = [one.with_(two)]
        while len(self.runs) > 1 and sum(len(r.hashes) for r in self.runs) > self.most:
            del self.runs[0]
