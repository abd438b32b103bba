"""Substring dedup: words that lie in a window of words which a document with a smaller id holds, too.

Windows of a whole match are found by anchors. A difference cover modulo a period p holds, for every
distance modulo p, two places that far apart. So of two occurrences of p + w - 1 equal words, wherever
they begin, some w words start at a place of the cover in both. Only the w words from such places
are hashed; those that two documents share are anchors, and each anchor is extended to the
full windows around it. Neighbouring windows make stretches, cut where a window's content says so, and
stretches, then the windows of those that are the first of their kind, are compared by 128 bits: grouped minima
of ids say what a smaller id has, and what that covers goes.

Hot passages are folded before they are shuffled, and windows meet their smallest id in a join whose large
keys can be split. No pairs of occurrences are made. Anchors that fit a filter of bounded size are looked up in it,
and more of them are joined; a wrong answer of the filter costs a comparison, never a result.

Null texts are empty; texts shorter than a window keep all words. A null id is larger than all others.
Rows that repeat an id do not remove each other's words. An empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import membership
from docloom.llm.byte_words import cut, joined, run_numbers
from docloom.llm.shingles import mixed
from docloom.llm.storage import keep
from docloom.llm.vocab import texts_of
from docloom.llm.words import ragged, slices
from docloom.llm.worker import release
from docloom.session import broadcast_if_small

WINDOW = 50
# A perfect difference set, every distance modulo 31 occurs once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end")])
SPANS = T.ArrayType(SPAN)
#: Windows in a stretch, about.
STRETCH = 64
#: Measured bytes of tables of numbers that are broadcast: their rows take several times as much in a hash table.
MOST_BROADCAST = 8 * 1024 * 1024


def cover_for(window: int) -> tuple[int, np.ndarray]:
    """(period, places modulo it): anchors take ``window - period + 1`` words."""
    if window >= PERIOD + 9:
        return PERIOD, np.array(COVER)
    period = max(1, window // 2)
    step = int(np.ceil(np.sqrt(period)))
    # the first places, and one in every ``step``
    return period, np.array(sorted({*range(step), *range(0, period, step)}))


def sliced(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Neighbouring rows with a bounded number of characters, or one row, and their texts."""
    for batch in batches:
        texts = texts_of(batch.column(text))
        for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
            yield batch.slice(a, b - a), texts[a:b]


def anchors_of(numbers: np.ndarray, before: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, text, place among all words) of the words hashed at places of the cover."""
    period, cover = cover_for(window)
    width = window - period + 1
    size = np.diff(before)
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(numbers)) - before[owner]
    fits = np.isin(np.arange(period), cover)[place % period] & (place + width <= size[owner]) & (size[owner] >= window)
    at = np.flatnonzero(fits)
    return mixed(run_numbers(numbers, width)[at]), owner[at], at


def anchors(own: DataFrame, window: int) -> DataFrame:
    """number, _id: every hashed run of words of ``own`` (_id, _print, _text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in sliced(batches, 2):
            words = cut(*joined(texts))
            found, owner, _ = anchors_of(words.numbers(), words.before, window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), rows.column(0).take(pa.array(owner))], names=["number", "_id"]
            )
        release()

    return own.mapInArrow(find, f"number bigint, _id {own.schema['_id'].dataType.simpleString()}")


def shared(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that occur with two ids or more, and the smallest of these (``least``)."""
    found = rows.groupBy(*keys).agg(
        F.min("_id").alias("least"), F.max("_id").alias("most"), F.max(F.col("_id").isNull()).alias("unknown")
    )
    return found.where((F.col("least") < F.col("most")) | (F.col("unknown") & F.col("least").isNotNull())).select(
        *keys, "least"
    )


def window_starts(at: np.ndarray, owner: np.ndarray, before: np.ndarray, window: int) -> np.ndarray:
    """Places of the windows that hold an anchor of ``window - period + 1`` words at ``at``."""
    period = cover_for(window)[0]
    first = np.maximum(at - (period - 1), before[owner])
    last = np.minimum(at, before[owner + 1] - window)
    n = int(before[-1]) + 1
    return np.flatnonzero(np.cumsum(np.bincount(first, minlength=n) - np.bincount(last + 1, minlength=n)) > 0)


class Windows:
    """The windows around the anchors of some texts: places of their first words among all words, texts, and 128 bits each."""

    def __init__(self, rows: pa.RecordBatch, texts: list[str], window: int, is_anchor):
        """``is_anchor`` tells anchors by number; without it column 3 of ``rows`` has their places."""
        words = cut(*joined(texts))
        numbers = words.numbers()
        if is_anchor:
            found, owner, at = anchors_of(numbers, words.before, window)
            chosen = is_anchor(found)
            owner, at = owner[chosen], at[chosen]
        else:
            lists = rows.column(3)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at = words.before[owner] + lists.flatten().to_numpy()
        self.starts = window_starts(at, owner, words.before, window)
        self.owner = np.searchsorted(words.before, self.starts, side="right") - 1
        self.hashes = [mixed(run_numbers(x, window)[self.starts]) for x in (numbers, words.numbers(1))]
        self.place = (self.starts - words.before[self.owner]).astype(np.int32)

    def stretches(self) -> np.ndarray:
        """Which windows begin a stretch: after a gap, in a new text, or after a window that says so by its content."""
        if not len(self.starts):
            return np.empty(0, np.int64)
        after = (self.starts[1:] != self.starts[:-1] + 1) | (self.owner[1:] != self.owner[:-1])
        after |= self.hashes[0][:-1] % np.uint64(STRETCH) == 0
        return np.flatnonzero(np.append(True, after))


def stretches(own: DataFrame, window: int, is_anchor) -> DataFrame:
    """one, two, _id, _print, at, n: runs of n windows around anchors, with 128 bits of all their words."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in sliced(batches, 2):
            found = Windows(rows, texts, window, is_anchor)
            first = found.stretches()
            size = np.diff(np.append(first, len(found.starts)))
            step = mixed(np.arange(len(found.starts), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64)) | np.uint64(1)
            sums = [mixed(np.add.reduceat(h * step, first)) if len(first) else h for h in found.hashes]
            named = [rows.column(i).take(pa.array(found.owner[first])) for i in (0, 1)]
            numbers = [pa.array(x.view(np.int64)) for x in sums]
            yield pa.RecordBatch.from_arrays(
                [*numbers, *named, pa.array(found.place[first]), pa.array(size.astype(np.int32))],
                names=["one", "two", "_id", "_print", "at", "n"],
            )
        release()

    kind = own.schema["_id"].dataType.simpleString()
    return own.mapInArrow(extend, f"one bigint, two bigint, _id {kind}, _print bigint, at int, n int")


def windows_in(own: DataFrame, window: int) -> DataFrame:
    """one, two, _id, _print, at: the windows from ``at`` to before ``at + n`` of each of the ``_left`` stretches of a text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in sliced(batches, 2):
            words = cut(*joined(texts))
            lists = rows.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            at, n = (lists.flatten().field(i).to_numpy().astype(np.int64) for i in (0, 1))
            owner = np.repeat(np.repeat(np.arange(len(lists)), sizes), n)
            place = ragged(at, n)
            starts = words.before[owner] + place
            hashes = [mixed(run_numbers(words.numbers(seed), window)[starts]).view(np.int64) for seed in (0, 1)]
            named = [rows.column(i).take(pa.array(owner)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, hashes), *named, pa.array(place.astype(np.int32))],
                names=["one", "two", "_id", "_print", "at"],
            )
        release()

    kind = own.schema["_id"].dataType.simpleString()
    return own.mapInArrow(split, f"one bigint, two bigint, _id {kind}, _print bigint, at int")


def with_places(own: DataFrame, common: DataFrame, window: int) -> DataFrame:
    """The rows of ``own`` that hold an anchor, and the places of theirs: by joins, for any number of anchors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in sliced(batches, 2):
            words = cut(*joined(texts))
            found, owner, at = anchors_of(words.numbers(), words.before, window)
            named = [rows.column(i).take(pa.array(owner)) for i in (0, 1)]
            place = pa.array((at - words.before[owner]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), *named, place], names=["number", "_id", "_print", "at"]
            )
        release()

    kind = own.schema["_id"].dataType.simpleString()
    placed = keep(own.mapInArrow(find, f"number bigint, _id {kind}, _print bigint, at int"), "placed-anchors")
    hits = placed.join(common, "number", "left_semi").groupBy("_id", "_print").agg(F.collect_set("at").alias("_places"))
    return joined_to(own, keep(hits, "anchor-places"))


def joined_to(own: DataFrame, per_text: DataFrame, how: str = "inner") -> DataFrame:
    """``own`` with what ``per_text`` (_id, _print and another column) has for its rows."""
    value = per_text.columns[-1]
    named = per_text.select(F.col("_id").alias("_i"), F.col("_print").alias("_p"), value)
    same_text = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_print") == F.col("_p"))
    return own.join(broadcast_if_small(named), same_text, how).select("_id", "_print", "_text", value)


@F.arrow_udf(SPANS)
def covered(runs: pa.Array) -> pa.Array:
    """The spans that stretches (at, end) cover, neighbours joined."""
    lists, offsets = [np.empty((2, 0), np.int64)], [0]
    flat, ends = runs.flatten(), runs.offsets.to_numpy()
    first, last = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
    for a, b in zip(ends - ends[0], ends[1:] - ends[0]):
        order = np.argsort(first[a:b], kind="stable")
        at, end = first[a:b][order], np.maximum.accumulate(last[a:b][order])
        new = np.flatnonzero(np.append(True, at[1:] > end[:-1])[: len(at)])
        lists.append(np.stack([at[new], end[np.append(new[1:], len(at)) - 1] if len(new) else end]))
        offsets.append(offsets[-1] + len(new))
    spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in np.concatenate(lists, axis=1)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def repeated_spans(own: DataFrame, window: int, total_bits: int = membership.BITS) -> DataFrame:
    """_id, _print, spans: the words to remove, from ``start`` to before ``end``, of each text that has any."""
    common = keep(shared(anchors(own, window), "number").select("number"), "shared-anchors")
    if common.count() * membership.BITS_PER_NUMBER <= 1 << total_bits:
        bits = own.sparkSession.sparkContext.broadcast(membership.filter_of(common, total_bits))
        found = stretches(own, window, lambda numbers: membership.may_hold(bits.value, numbers, total_bits))
    else:
        found = stretches(with_places(own, common, window), window, None)
    found = keep(found, "stretches")
    later = (F.col("_id") > F.col("least")) | (F.col("_id").isNull() & F.col("least").isNotNull())
    least = keep(shared(found, "one", "two"), "least-ids")
    judged = found.join(broadcast_if_small(least, MOST_BROADCAST), ["one", "two"], "left").withColumn(
        "later", F.coalesce(later, F.lit(False))
    )
    judged = keep(judged.select("_id", "_print", "at", "n", "later"), "judged-stretches")
    rest = judged.where("not later").groupBy("_id", "_print").agg(F.collect_list(F.struct("at", "n")).alias("_left"))
    windows = windows_in(joined_to(own, keep(rest, "stretches-left")), window)
    least = keep(shared(windows, "one", "two"), "least-ids")
    alone = windows.join(broadcast_if_small(least, MOST_BROADCAST), ["one", "two"]).where(later)
    gone = judged.where("later").select("_id", "_print", "at", (F.col("at") + F.col("n") - 1 + window).alias("end"))
    gone = gone.unionByName(alone.select("_id", "_print", "at", (F.col("at") + window).alias("end")))
    return gone.groupBy("_id", "_print").agg(F.collect_list(F.struct("at", "end")).alias("runs")).select(
        "_id", "_print", covered("runs").alias("spans")
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_words, n_removed, spans, kept: the words of each row that stay, joined by one blank, and the spans of those that go.

    A word goes if it lies in ``window`` words that also occur, word by word, in a row with a smaller id.
    Windows are judged on the input.
    """
    own = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_print"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    met = joined_to(own, keep(repeated_spans(own, window, **options), "repeated-spans"), "left")
    met = met.select("_id", "_text", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, spans in zip(texts_of(batch.column(1)), batch.column(2).to_pylist()):
                # bytes are split at the same six characters
                words = text.encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                for span in reversed(spans):
                    del words[span["start"] : span["end"]]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            counts = [pa.array(n, pa.int64()) for n in (total, removed)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, batch.column(2), pa.array(kept, pa.string())],
                names=[id_col, "n_words", "n_removed", "spans", "kept"],
            )
        release()

    kind = own.schema["_id"].dataType.simpleString()
    return met.mapInArrow(strip, f"`{id_col}` {kind}, n_words bigint, n_removed bigint, spans {SPANS.simpleString()}, kept string")
