"""Token counts of every prefix of a text by dynamic programming.

The tokens of a word's prefix are those of a shorter prefix and one more
token that fits the last of them: exactly one does. So a word's counts
follow from left to right, words with a common beginning share them, and a text's counts
are those of its words added up. Truncation and budget questions then read a
number instead of encoding again.

Prefixes are those of the text as the tokenizer normalises it. Counts may fall as a prefix
grows, since a longer word may need fewer tokens. Null texts are empty and have 0 tokens.
Ids may be null or repeated: every row gives a row, and an empty table gives none.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import vocab
from docloom.llm.bpe import Merges, is_space, merges
from docloom.llm.worker import once
from docloom.llm.words import Numbers, distinct_words, ragged, slices

LIMIT = 2048


class Counter:
    """Counts at the prefixes of words, in the order of the alphabet so that common beginnings are done once."""

    def __init__(self, model: Merges):
        self.model = model

    def extend(self, word: bytes, same: int, last: list[int], count: list[int], whole: list[int]) -> None:
        """Bring the lists, true for the first ``same`` bytes, up to ``word``.

        At byte j: the last token and the number of tokens of what may go on,
        and the number of tokens if the word ends there. Of the tokens that end at a byte exactly one
        fits what is before it.
        """
        del last[same + 1 :], count[same + 1 :], whole[same + 1 :]
        for j in range(same + 1, len(word) + 1):
            token, size = self.ending(word, j, last, self.model.middle, self.model.longest_middle)
            _, final = self.ending(word, j, last, self.model.final, self.model.longest_final)
            whole.append(count[j - final] + 1)
            last.append(token)
            count.append(count[j - size] + 1)

    def ending(
        self, word: bytes, j: int, last: list[int], table: dict[bytes, int], longest: dict[bytes, int]
    ) -> tuple[int, int]:
        """(token, its bytes): the one of ``table`` that ends at byte j and fits."""
        model = self.model
        known, many, get = model.memo, model.size, table.get
        for size in range(min(j, longest.get(word[j - 2 : j] if j > 1 else word[:1], 1)), 0, -1):
            token = get(word[j - size : j])
            if token is not None:
                if size == j:
                    break
                fits = known.get(last[j - size] * many + token)
                if fits is None:
                    fits = model.fits(last[j - size], token)
                if fits:
                    break
        return token, size

    def counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(counts at all code points of all words in a row, code points per word); white space counts 0."""
        found: list[list[int]] = [[]] * len(words)
        before, last, count, whole = b"", [-1], [0], [0]
        for i in sorted(range(len(words)), key=words.__getitem__):
            word = words[i]
            if is_space(word):
                found[i] = [0] * len(word.decode("utf-8", "replace"))
                continue
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            self.extend(word, same, last, count, whole)
            before = word
            ends = whole[1:]
            if not word.isascii():
                ends = [c for c, b in zip(ends, [*word[1:], 0]) if b & 0xC0 != 0x80]
            found[i] = ends
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((c for ends in found for c in ends), np.int32, int(size.sum())), size


def _plain(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts at every prefix of all normalised texts in a row, code points before each text)."""
    numbers = once(("prefix numbers", path), lambda: Numbers(Counter(merges(path)).counts))
    words, place, before, _ = distinct_words(vocab.normalised(path, texts), attach_blank=False)
    start, size, flat = numbers.of(words)
    last = flat[start + size - 1] if len(start) else size
    size_at, tokens = size[place].astype(np.int64), last[place].astype(np.int64)
    seen = np.concatenate([[0], np.cumsum(tokens)])
    in_text = np.repeat(seen[before[:-1]], np.diff(before))
    counts = flat[ragged(start[place], size_at)] + np.repeat(seen[:-1] - in_text, size_at)
    return counts, np.concatenate([[0], np.cumsum(size_at)])[before]


def _marked(path: str, text: str) -> np.ndarray:
    """Counts for a text with special strings: one of them is a single token once it is complete."""
    pattern, _ = vocab.specials(path)
    found = pattern.split(text)
    out, seen = [], 0
    for k in range(0, len(found), 2):
        special = found[k + 1] if k + 1 < len(found) else ""
        counts, _ = _plain(path, [found[k] + special[:-1]])
        out.append(counts + seen)
        if special:
            before = len(counts) - len(special) + 1
            seen += (int(counts[before - 1]) if before else 0) + 1
            out.append(np.array([seen]))
    return np.concatenate(out)


def prefix_counts(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts at every prefix of all texts in a row, where each text's begin; one entry more than texts)."""
    pattern, _ = vocab.specials(path)
    marked = [i for i, t in enumerate(texts) if pattern and "<|" in t and pattern.search(t)]
    counts, starts = _plain(path, texts)
    if not marked:
        return counts, starts
    lists = np.split(counts, starts[1:-1])
    for i in marked:
        lists[i] = _marked(path, texts[i])
    return np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])


def _over_texts(docs: DataFrame, id_col: str, text_col: str, fields: list, row) -> DataFrame:
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = vocab.texts_of(batch.column(2))
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *row(texts[a:b])], names=schema.names)

    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes")
    return docs.select(id_col, size, F.col(text_col)).mapInArrow(run, schema)


def prefixes(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, counts (array<int>): the token count of every prefix; element i is for i + 1 code points."""

    def row(texts: list[str]) -> list[pa.Array]:
        counts, starts = prefix_counts(path, texts)
        return [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(counts, pa.int32()))]

    return _over_texts(docs, id_col, text_col, [T.StructField("counts", T.ArrayType(T.IntegerType(), False))], row)


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit, n_fit: whether a text exceeds ``limit``, and how much of it does not.

    ``n_fit`` is the length in code points of the longest prefix of at most ``limit`` tokens.
    """

    def row(texts: list[str]) -> list[pa.Array]:
        counts, starts = prefix_counts(path, texts)
        total = np.where(np.diff(starts) > 0, counts[starts[1:] - 1], 0) if len(counts) else np.zeros(len(texts))
        fit = np.diff(starts)
        for i in np.flatnonzero(total > limit):
            within = np.flatnonzero(counts[starts[i] : starts[i + 1]] <= limit)
            fit[i] = within[-1] + 1 if len(within) else 0
        return [pa.array(total, pa.int64()), pa.array(total > limit), pa.array(fit, pa.int64())]

    fields = [("n_tokens", T.LongType()), ("over_limit", T.BooleanType()), ("n_fit", T.LongType())]
    return _over_texts(docs, id_col, text_col, [T.StructField(n, t) for n, t in fields], row)
