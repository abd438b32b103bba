"""Words of texts as 64-bit numbers, cut from UTF-8 bytes in arrays; numbers of runs of neighbouring words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from docloom.llm.shingles import mixed

_TIMES = np.uint64(0x9E3779B97F4A7C15)
# The bytes of [\x20\x09-\x0D].
WHITE = (0x20, *range(0x09, 0x0E))


@dataclass(frozen=True)
class Words:
    """All words of some texts in a row: their bytes, where each begins among them, words before each text.

    ``start`` and ``end`` are places in the texts' bytes, one blank after every text.
    """

    letters: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    before: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def numbers(self, seed: int = 0) -> np.ndarray:
        """A number for each word: a sum over its bytes with a multiplier for each place, mixed. Seeds are independent."""
        if not len(self):
            return np.empty(0, np.uint64)
        size = self.end - self.start
        place = np.arange(len(self.letters)) - np.repeat(self.first, size)
        steps = np.arange(1, int(size.max()) + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(40))
        factors = mixed(steps * _TIMES) | np.uint64(1)
        return mixed(np.add.reduceat((self.letters.astype(np.uint64) + np.uint64(1)) * factors[place], self.first))

    def strings(self) -> pa.Array:
        """The words as a binary array."""
        ends = np.append(self.first, len(self.letters)).astype(np.int64)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.letters))]
        return pa.Array.from_buffers(pa.large_binary(), len(self), buffers)


def table_of(separators: tuple[int, ...]) -> np.ndarray:
    """For each byte whether it may be in a word."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


INSIDE = table_of(WHITE)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(the UTF-8 bytes of all texts, a blank after each; where each ends)."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    return data, np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))


def cut(data: np.ndarray, ends: np.ndarray, inside: np.ndarray = INSIDE) -> Words:
    """The words of ``joined`` texts; the blank must separate words."""
    within = inside[data]
    edge = np.flatnonzero(np.diff(within, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    before = np.concatenate([[0], np.searchsorted(start, ends)])
    return Words(data[within], np.cumsum(end - start) - (end - start), start, end, before)


def run_numbers(numbers: np.ndarray, width: int) -> np.ndarray:
    """For each place the polynomial of the ``width`` numbers from there on; the last ``width - 1`` places mean nothing."""
    padded = np.concatenate([numbers, np.zeros(width, np.uint64)])
    done, out = 0, None
    power, size = padded, 1
    while done < width:
        if width & size:
            if out is None:
                out, done = power, size
            else:
                shifted = np.concatenate([power[done:], np.zeros(done, np.uint64)])
                out, done = out * _power(size) + shifted, done + size
        shifted = np.concatenate([power[size:], np.zeros(size, np.uint64)])[: len(power)]
        power, size = power * _power(size) + shifted, 2 * size
    return out[: len(numbers)]


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_TIMES), exponent, 1 << 64))
