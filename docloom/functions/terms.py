"""Word counts of token lists, batch by batch in Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T


def term_counts(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, word, count) of every distinct word of every row, row lengths, and the words.

    Triples are in row order, ``word`` is a place in the returned words, and a
    row's length is that of its vector of counts.
    """
    words = lists.flatten().dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    kinds = max(1, len(words.dictionary))
    key, count = np.unique(row * kinds + words.indices.to_numpy(), return_counts=True)
    row, word = key // kinds, key % kinds
    length = np.sqrt(np.bincount(row, count.astype(float) ** 2, minlength=len(lists)))
    return row, word, count, length, words.dictionary


PAIRS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())]))


def unit_pairs(lists: pa.Array) -> pa.Array:
    """Each token list as its distinct words with their counts at unit length."""
    row, word, count, length, words = term_counts(lists)
    pairs = pa.StructArray.from_arrays([words.take(pa.array(word)), pa.array(count / length[row])], ["term", "weight"])
    ends = np.searchsorted(row, np.arange(len(lists) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


unit_weights = F.arrow_udf(unit_pairs, PAIRS)
