"""A filter of bounded size that says which 64-bit numbers may belong to a set, and misses none that do.

The leading bits of a number name a segment of the filter, and a segment is built in a group of its own,
so that the driver receives finished segments, ``2 ** BITS / 8`` bytes in all whatever the set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shingles import mixed

BITS = 28
SEGMENT_BITS = 8
#: Bits a number that keep wrong answers below one in a hundred.
BITS_PER_NUMBER = 10


def places(numbers: np.ndarray, width: int) -> list[np.ndarray]:
    """The bits that stand for each number within its segment of ``2 ** width`` bits."""
    mask, one = np.uint64((1 << width) - 1), mixed(numbers)
    two = mixed(one + np.uint64(1))
    return [x & mask for x in (one, one >> np.uint64(width), two, two >> np.uint64(width))]


def may_hold(bits: np.ndarray, numbers: np.ndarray, total_bits: int = BITS) -> np.ndarray:
    """Which ``numbers`` may be in the set that ``bits`` stand for."""
    width = total_bits - SEGMENT_BITS
    base = (numbers >> np.uint64(64 - SEGMENT_BITS)) << np.uint64(width)
    found = np.ones(len(numbers), bool)
    for place in places(numbers, width):
        at = np.flatnonzero(found)
        if not len(at):
            break
        where = base[at] | place[at]
        found[at] = (bits[(where >> np.uint64(3)).astype(np.int64)] >> (where & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def filter_of(numbers: DataFrame, total_bits: int = BITS) -> np.ndarray:
    """The filter of the one bigint column of ``numbers``; no rows give a filter that holds nothing."""
    width = total_bits - SEGMENT_BITS
    column = numbers.columns[0]

    def build(table: pa.Table) -> pa.Table:
        held = table.column("number").to_numpy().view(np.uint64)
        bits = np.zeros(1 << width, bool)
        for place in places(held, width):
            bits[place.astype(np.int64)] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"segment": pa.array([table.column("segment")[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    segment = F.shiftrightunsigned(F.col(column), 64 - SEGMENT_BITS).cast("int")
    segments = (
        numbers.select(segment.alias("segment"), F.col(column).alias("number"))
        .groupBy("segment")
        .applyInArrow(build, "segment int, bits binary")
        .toArrow()
    )
    out = np.zeros(1 << (total_bits - 3), np.uint8)
    for at, data in zip(segments["segment"].to_pylist(), segments["bits"].to_pylist()):
        first = at << (width - 3)
        out[first : first + (1 << (width - 3))] = np.frombuffer(data, np.uint8)
    return out
