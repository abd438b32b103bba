"""Word n-grams of texts as sets of 64-bit numbers, in arrays.

Words are runs of anything but ``[\\x20\\x09-\\x0D]``. A word's number is a sum over its
bytes with a multiplier for each place, an n-gram's a polynomial of its words' numbers, both
mixed. A text of fewer than n words, but at least one, has the n-gram of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from docloom.llm.words import mixed, slices

N = 5
_TIMES = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word of all texts in a row, words before each text)."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    # a blank after each text keeps words of neighbours apart
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
    inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    before = np.concatenate([[0], np.searchsorted(start, ends)])
    if not len(start):
        return np.empty(0, np.uint64), before
    size = end - start
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    factors = mixed(np.arange(1, int(size.max()) + 1, dtype=np.uint64) * _TIMES) | np.uint64(1)
    return mixed(np.add.reduceat(letters * factors[place], first)), before


def sets(texts: list[str], n: int = N) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, b, numbers, before): the sorted n-gram sets of texts a to b, a slice at a time, and where each begins."""
    for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
        words, before = word_numbers(texts[a:b])
        count = np.diff(before)
        grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        starts = np.concatenate([[0], np.cumsum(grams)])
        at = np.arange(starts[-1]) + np.repeat(before[:-1] - starts[:-1], grams)
        numbers = np.zeros(len(at), np.uint64)
        owner_end = np.repeat(before[1:], grams)
        padded = np.concatenate([words, np.zeros(n, np.uint64)])
        for k in range(n):
            numbers = numbers * _TIMES + np.where(at + k < owner_end, padded[at + k], np.uint64(0))
        numbers = mixed(numbers)
        kept = []
        for i in range(b - a):
            own = np.sort(numbers[starts[i] : starts[i + 1]])
            kept.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
        sizes = np.fromiter(map(len, kept), np.int64, len(kept))
        yield a, b, np.concatenate(kept) if kept else numbers, np.concatenate([[0], np.cumsum(sizes)])
