"""Byte pair encoding of words by speculation and verification, and decoding.

Greedy longest match proposes tokens for a word. A sequence of tokens is what
the merges give exactly if no merge would have joined two neighbours earlier than the
merges that built them, and that can be looked up pair by pair: one vectorised walk
down the facing edges of both merge trees tests every adjacent pair of a batch.
Words with a failing pair, and only those, go through the merges one by one.

Texts are cut into words and distinct words encoded once per worker. Null
texts are empty and have no tokens. Ids may be null or repeated; every row gives a row.
Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docloom.llm import vocab
from docloom.llm.worker import once
from docloom.llm.words import SPACE, Numbers, classes, slices

NEVER = 2**31 - 1
#: Bytes of a word from which pairs are kept in a heap.
LONG = 200


class Merges:
    """The merges of a tokenizer file whose words end in a marked token, as arrays over token ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, suffix, byte = model["vocab"], model["end_of_word_suffix"], vocab.byte_of_char()
        self.size = max(ids.values()) + 1
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        self.rank = np.full(self.size, -1)
        self.spelled: list[bytes] = [b""] * self.size
        ends = np.zeros(self.size, bool)
        self.single: dict[bool, dict[int, int]] = {False: {}, True: {}}
        for char, b in byte.items():
            for final, name in ((False, char), (True, char + suffix)):
                self.spelled[ids[name]], ends[ids[name]] = bytes([b]), final
                self.single[final][b] = ids[name]
        self.made: list[int] = []
        self.rank_by_key: dict[int, int] = {}
        for rank, (first, second) in enumerate(model["merges"]):
            a, b, new = ids[first], ids[second], ids[first + second]
            self.left[new], self.right[new], self.rank[new] = a, b, rank
            self.spelled[new], ends[new] = self.spelled[a] + self.spelled[b], ends[b]
            self.rank_by_key[a * self.size + b] = rank
            self.made.append(new)
        keys = np.fromiter(self.rank_by_key, np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(self.rank_by_key.values(), np.int64)[order]
        self.memo: dict[int, bool] = {}
        self._tables(ends)

    def _tables(self, ends: np.ndarray) -> None:
        """Tokens by spelling, without those that no merging of their own letters gives."""
        whole = self.rank >= 0
        sound = np.ones(self.size, bool)
        made = np.flatnonzero(whole)
        sound[made] = self.compatible(self.left[made], self.right[made], joined=True)
        for t in made[np.argsort(self.rank[made])]:
            sound[t] &= sound[self.left[t]] and sound[self.right[t]]
        self.middle, self.final = {}, {}
        self.longest: dict[bytes, int] = {}
        self.longest_middle: dict[bytes, int] = {}
        self.longest_final: dict[bytes, int] = {}
        for t in np.flatnonzero(sound):
            if word := self.spelled[t]:
                (self.final if ends[t] else self.middle)[word] = int(t)
                self.longest[word[:2]] = max(self.longest.get(word[:2], 1), len(word))
                by_end = self.longest_final if ends[t] else self.longest_middle
                by_end[word[-2:]] = max(by_end.get(word[-2:], 1), len(word))
        self.most_final = max(map(len, self.final), default=0)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, ``NEVER`` if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether tokens a and b stay apart when their letters are merged side by side.

        Time runs backwards: of the two facing tokens the one made later is taken
        apart, until both are single. A pair clashes if its merge comes
        before the merge that used up either of them; at equal rank the left one
        goes first. ``joined``: a and b are to be merged at last, not to stay apart.
        """
        fine = np.ones(len(a), bool)
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        used_a, used_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        top = joined
        while len(live):
            merged = self.rank_of(a, b)
            clash = (merged < used_a) & (merged <= used_b) & (not top)
            fine[live[clash]] = False
            made_a, made_b = self.rank[a], self.rank[b]
            go = ~clash & ((made_a >= 0) | (made_b >= 0))
            live, a, b, used_a, used_b, made_a, made_b = (
                x[go] for x in (live, a, b, used_a, used_b, made_a, made_b)
            )
            split_a = made_a > made_b
            used_a, used_b = np.where(split_a, made_a, used_a), np.where(split_a, used_b, made_b)
            a, b = np.where(split_a, self.right[a], a), np.where(split_a, b, self.left[b])
            top = False
        return fine

    def fits(self, a: int, b: int) -> bool:
        """``compatible`` for one pair, remembered."""
        key = a * self.size + b
        if key not in self.memo:
            if len(self.memo) > 2_000_000:
                self.memo.clear()
            self.memo[key] = self._walk(a, b)
        return self.memo[key]

    def _walk(self, a: int, b: int) -> bool:
        used_a = used_b = NEVER
        while True:
            merged = self.rank_by_key.get(a * self.size + b, NEVER)
            if merged < used_a and merged <= used_b:
                return False
            made_a, made_b = int(self.rank[a]), int(self.rank[b])
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                used_a, a = made_a, int(self.right[a])
            else:
                used_b, b = made_b, int(self.left[b])

    def propose(self, word: bytes) -> list[int]:
        """The longest token at every place, from left to right."""
        out, at, n = [], 0, len(word)
        while at < n:
            found = self.final.get(word[at:]) if n - at <= self.most_final else None
            if found is None:
                size = min(self.longest.get(word[at : at + 2], 1), n - at - 1)
                while size > 1 and word[at : at + size] not in self.middle:
                    size -= 1
                found = self.middle[word[at : at + size]]
                at += size
            else:
                at = n
            out.append(found)
        return out

    def merge(self, word: bytes) -> list[int]:
        """The merges in their order, one at a time, of equal ones the leftmost first."""
        if len(word) > LONG:
            return self.merge_long(word)
        out = [self.single[False][b] for b in word[:-1]] + [self.single[True][word[-1]]]
        size, rank_of = self.size, self.rank_by_key.get
        ranks = [rank_of(a * size + b, NEVER) for a, b in zip(out, out[1:])]
        while ranks and (rank := min(ranks)) < NEVER:
            at = ranks.index(rank)
            out[at : at + 2] = [self.made[rank]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(out[at - 1] * size + out[at], NEVER)
            if at < len(ranks):
                ranks[at] = rank_of(out[at] * size + out[at + 1], NEVER)
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """``merge`` with the pairs in a heap and the tokens in a linked list: n log n for n bytes."""
        out = [self.single[False][b] for b in word[:-1]] + [self.single[True][word[-1]]]
        size, rank_of, n = self.size, self.rank_by_key.get, len(out)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i) for i, (a, b) in enumerate(zip(out, out[1:])) if (r := rank_of(a * size + b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            # a token that was merged meanwhile is gone, or makes another pair
            if right < 0 or out[at] < 0 or rank_of(out[at] * size + out[right]) != rank:
                continue
            out[at], out[right] = self.made[rank], -1
            after[at] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (r := rank_of(out[at] * size + out[beyond])) is not None:
                    heapq.heappush(heap, (r, at))
            if (left := before[at]) >= 0 and (r := rank_of(out[left] * size + out[at])) is not None:
                heapq.heappush(heap, (r, left))
        return [t for t in out if t >= 0]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per word): proposals, all adjacent pairs tested, failing words merged."""
        lists = [self.propose(w) for w in words]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((t for ids in lists for t in ids), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(lists)), size)
        inside = owner[1:] == owner[:-1]
        keys, place = np.unique((flat[:-1] * self.size + flat[1:])[inside], return_inverse=True)
        fine = self.compatible(keys // self.size, keys % self.size)
        failing = np.unique(owner[1:][inside][~fine[place]])
        if len(failing):
            for i in failing:
                lists[i] = self.merge(words[i])
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((t for ids in lists for t in ids), np.int64, int(size.sum()))
        return flat, size


def merges(path: str) -> Merges:
    return once(("merges", path), lambda: Merges(path))


def is_space(word: bytes) -> bool:
    return classes()[ord(word.decode("utf-8", "replace")[0])] >= SPACE


def _word_ids(path: str):
    def make(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        real = [i for i, w in enumerate(words) if not is_space(w)]
        flat, found = merges(path).encode([words[i] for i in real])
        size = np.zeros(len(words), np.int64)
        size[real] = found
        return flat, size

    return make


def word_encode(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids before each text) by a word-level BPE file that drops white space."""
    numbers = once(("word numbers", path), lambda: Numbers(_word_ids(path)))
    return vocab.gathered(path, texts, numbers, attach_blank=False)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array<int>): the token ids of every whole text."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = vocab.texts_of(batch.column(1))
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                ids, before = word_encode(path, texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _token_strings(path: str) -> pa.Array:
    known = vocab.Tokenizer.from_file(path)
    return pa.array([known.id_to_token(i) or "" for i in range(known.get_vocab_size())], pa.string())


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` and its ids as text, null for null: tokens, special ones too, with blanks between.

    That is what a file without a decoder defines. ``text_col`` must be a new column.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])
    column = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = once(("token strings", path), lambda: _token_strings(path))
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes.astype(np.int64)):
                part = batch.slice(a, b - a)
                lists = part.column(column)
                ends = np.concatenate([[0], np.cumsum(sizes[a:b])])
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings.take(lists.flatten()))
                text = pc.if_else(lists.is_valid(), pc.binary_join(tokens, " "), None)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=schema.names)

    return encoded.mapInArrow(run, schema)
