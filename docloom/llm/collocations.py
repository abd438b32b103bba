"""Collocations of two to four words per language, mined shard by shard (SON) and counted exactly.

Every language is dealt into a few shards by document. A phrase with ``support`` occurrences in all
has its share of them, by words, in one shard at least; so each shard is mined completely
at its share of the support, and the union of what shards find misses nothing. A shard is as
large as the corpus makes it, so many tasks mine it together: map tasks fold phrases into sorted numbers with counts,
and groups of a bounded number of phrases add them up. What a shard
does not report it holds at most one time less than its support, which bounds the
total of a phrase from above; phrases whose bound is below the support go at once. A second pass over
the texts counts the candidates, as strings, all over the corpus; numbers that collide only cost a count.

Candidates are looked up in a filter of bounded size. Hot phrases are folded in map tasks. Null languages
are ``und``, null texts empty; empty tables and texts without words give no rows. Repeated rows count each
time. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import membership
from docloom.llm.byte_words import Words, cut, joined, table_of
from docloom.llm.shingles import mixed
from docloom.llm.storage import keep
from docloom.llm.vocab import texts_of
from docloom.llm.words import slices
from docloom.llm.worker import release
from docloom.session import broadcast_if_small

LONGEST = 4
SUPPORT = 30
SHARDS = 8
TOP = 2_000
#: A longer phrase takes a shorter one in if it has this share of its occurrences, in percent.
TAKEN_IN = 80
SCALE = 2_000_000
WORDS_PER_GROUP = 500_000
PHRASES_HELD = 4_000_000
COUNTED_HELD = 1_000_000
#: Candidates whose counts are added up in one group, about.
PHRASES_PER_GROUP = 20_000

# What ends a piece, and what else separates words.
PIECE_ENDS = (*map(ord, ".,;:!?"), *range(0x0A, 0x0E))
INSIDE = table_of((0x20, 0x09, *PIECE_ENDS))
ENDS = ~table_of(PIECE_ENDS)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_TIMES = np.uint64(0x9E3779B97F4A7C15)
#: Numbers lose their last bits on the way; what is left still tells phrases apart but for a few.
STORED = 6


def pieces_of(texts: list[str]) -> tuple[Words, np.ndarray]:
    """The lower-case words of all texts, and for each how many words of its piece, itself among them, are left."""
    data, ends = joined(texts)
    data = LOWER[data]
    words = cut(data, ends, INSIDE)
    if not len(words):
        return words, np.empty(0, np.int64)
    breaks = ENDS[data]
    breaks[ends - 1] = True
    piece = np.cumsum(breaks)[words.start]
    last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), len(piece) - 1)
    return words, last[np.searchsorted(last, np.arange(len(piece)))] - np.arange(len(piece)) + 1


def phrases_of(numbers: np.ndarray, left: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, number, place of the first word) of all phrases of n words, for n from 1 on; ``own``: their language's number."""
    run, padded = numbers, np.concatenate([numbers, np.zeros(LONGEST, np.uint64)])
    for n in range(1, LONGEST + 1):
        if n > 1:
            run = run * _TIMES + padded[n - 1 : n - 1 + len(run)]
        at = np.flatnonzero(left >= n)
        yield n, mixed(run[at] + own[at]), at


def language_number(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))


def folded(parts: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different numbers and how often they occur."""
    numbers = np.concatenate(parts)
    if counts is None:
        return np.unique(numbers, return_counts=True)
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = starts_of(numbers)
    return numbers[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else first


def to_six(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - STORED :].tobytes()


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // STORED, 8), np.uint8)
    out[:, 8 - STORED :] = np.frombuffer(data, np.uint8).reshape(-1, STORED)
    return out.view("<u8").ravel()


def cut_short(numbers: np.ndarray) -> np.ndarray:
    """Numbers as they are stored."""
    low = np.uint64(8 * (8 - STORED))
    return (numbers >> low) << low


def sorted_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of one language and shard side by side."""
    return batch.take(pc.sort_indices(batch, sort_keys=[("_lang", "ascending"), ("_shard", "ascending")]))


def runs_of(batch: pa.RecordBatch, before: np.ndarray) -> Iterator[tuple[tuple[str, int], int, int]]:
    """((language, shard), first word, end) of neighbouring rows that agree on both."""
    keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    at = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[at]:
            yield keys[at], int(before[at]), int(before[i])
            at = i


def owned(docs: DataFrame, lang_col: str, text_col: str, id_col: str, shards: int) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"),
        F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int").alias("_shard"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )


def _word_counts():
    @F.arrow_udf("bigint")
    def word_counts(column: pa.Array) -> pa.Array:
        texts, out = texts_of(column), []
        for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
            out.append(np.diff(cut(*joined(texts[a:b]), INSIDE).before))
        return pa.array(np.concatenate(out) if out else np.empty(0, np.int64))

    return word_counts


def shares(own: DataFrame, support: int) -> DataFrame:
    """_lang, _shard, n (words of the language), least (the shard's support), slack (most that all shards keep back)."""
    counted = keep(own.groupBy("_lang", "_shard").agg(F.sum(_word_counts()("_text")).alias("words")), "shard-words")
    total = counted.groupBy("_lang").agg(F.sum("words").alias("n"))
    least = F.expr(f"cast((cast(words as decimal(18,0)) * cast({support} as decimal(18,0)) + n - 1) div n as bigint)")
    both = keep(counted.join(total, "_lang").where("words > 0").withColumn("least", least), "shard-support")
    slack = both.groupBy("_lang").agg(F.sum(F.col("least") - 1).alias("slack"))
    return keep(both.join(slack, "_lang").select("_lang", "_shard", "n", "least", "slack"), "shard-shares")


PACKED = "_lang string, _shard int, bucket int, once binary, often binary, counts binary"


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    names = [part.split()[0] for part in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def local_counts(own: DataFrame, buckets: int) -> DataFrame:
    """Per language, shard and bucket of numbers the phrases of each task's texts, with their counts."""

    def close(held: dict[tuple[str, int], list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for (lang, shard), parts in held.items():
            numbers, counts = folded(parts)
            numbers = cut_short(numbers)
            bucket = bucket_of(numbers, buckets)
            first, rows = starts_of(bucket), []
            for a, b in zip(first, [*first[1:], len(numbers)]):
                many = counts[a:b] > 1
                often = counts[a:b][many].astype("<u4").tobytes()
                own = numbers[a:b]
                rows.append((lang, shard, int(bucket[a]), to_six(own[~many]), to_six(own[many]), often))
            yield packed(rows)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {}, 0
        for batch in batches:
            batch = sorted_rows(batch)
            texts = batch.column(2).to_pylist()
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                words, left = pieces_of(texts[a:b])
                runs = list(runs_of(batch.slice(a, b - a), words.before))
                seed = np.repeat(np.array([language_number(k[0]) for k, _, _ in runs]), [q - p for _, p, q in runs])
                for _, numbers, at in phrases_of(words.numbers(), left, seed):
                    n += len(at)
                    for key, p, q in runs:
                        own = numbers[np.searchsorted(at, p) : np.searchsorted(at, q)]
                        if len(own):
                            held.setdefault(key, []).append(own)
                if n >= PHRASES_HELD:
                    yield from close(held)
                    held, n = {}, 0
        yield from close(held)
        release()

    return own.mapInArrow(fold, PACKED)


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of all rows added up."""
    once = [from_six(x) for x in table.column("once").to_pylist()]
    often = [from_six(x) for x in table.column("often").to_pylist()]
    counts = [np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("counts").to_pylist()]
    return folded([*once, *often], [*[np.ones(len(x), np.int64) for x in once], *counts])


def mined(counts: DataFrame, shares: DataFrame) -> DataFrame:
    """_lang, bucket, slack, numbers, gains: what each shard finds at its support, and by how much it passes what it may keep back."""

    def mine(table: pa.Table) -> pa.Table:
        numbers, counts = unpacked(table)
        back = table.column("least")[0].as_py() - 1
        found = counts > back
        row = [table.column(c)[0].as_py() for c in ("_lang", "bucket", "slack")]
        return pa.table(
            {
                "_lang": pa.array(row[:1], pa.string()),
                "bucket": pa.array(row[1:2], pa.int32()),
                "slack": pa.array(row[2:], pa.int64()),
                "numbers": pa.array([to_six(numbers[found])], pa.binary()),
                "gains": pa.array([(counts[found] - back).astype("<u8").tobytes()], pa.binary()),
            }
        )

    rows = counts.join(broadcast_if_small(shares.select("_lang", "_shard", "least", "slack")), ["_lang", "_shard"])
    return rows.groupBy("_lang", "_shard", "bucket").applyInArrow(
        mine, "_lang string, bucket int, slack bigint, numbers binary, gains binary"
    )


def candidates(found: DataFrame, support: int) -> DataFrame:
    """number: the union of what shards found, without phrases that cannot reach the support."""

    def unite(table: pa.Table) -> pa.Table:
        parts = [from_six(x) for x in table.column("numbers").to_pylist()]
        gains = [np.frombuffer(x, "<u8").astype(np.int64) for x in table.column("gains").to_pylist()]
        numbers, total = folded(parts, gains)
        chosen = numbers[total + table.column("slack")[0].as_py() >= support]
        return pa.table({"number": chosen.view(np.int64)})

    return found.groupBy("_lang", "bucket").applyInArrow(unite, "number bigint")


def spelled(strings: pa.Array, at: np.ndarray, n: int) -> pa.Array:
    """The phrases of n words from each place on, joined by a blank."""
    parts = [strings.take(pa.array(at + i)) for i in range(n)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if n > 1 else parts[0]


class Tally:
    """Counts by number, and the string of each number, made once while it is held."""

    def __init__(self):
        self.numbers, self.counts, self.names, self.seen = [], [], [], np.empty(0, np.uint64)

    def add(self, numbers: np.ndarray, at: np.ndarray, spell) -> None:
        own, first, count = np.unique(numbers, return_index=True, return_counts=True)
        self.numbers.append(own)
        self.counts.append(count)
        place = np.searchsorted(self.seen, own)
        new = np.append(self.seen, np.uint64(0))[place] != own if len(self.seen) else np.ones(len(own), bool)
        new |= place == len(self.seen)
        if new.any():
            self.names.append((own[new], spell(at[first[new]])))
            self.seen = np.insert(self.seen, place[new], own[new])

    def close(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(sorted numbers, strings, counts)"""
        numbers, counts = folded(self.numbers, self.counts)
        order = np.argsort(np.concatenate([own for own, _ in self.names]), kind="stable")
        return numbers, pa.concat_arrays([names for _, names in self.names]).take(pa.array(order)), counts


def bucket_of(numbers: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each number; sorted numbers give sorted buckets."""
    return ((numbers >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def starts_of(sorted_: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])[: len(sorted_)])


LISTS = "lang string, words int, bucket int, phrases array<string>, counts array<bigint>"


def counted(own: DataFrame, is_candidate, support: int, buckets: int) -> DataFrame:
    """lang, phrase, words, f: the exact counts of candidates with ``support`` occurrences or more."""

    def close(held: dict[tuple[str, int], Tally]) -> Iterator[pa.RecordBatch]:
        for (lang, n), tally in held.items():
            numbers, names, counts = tally.close()
            bucket = bucket_of(numbers, buckets)
            first = starts_of(bucket)
            ends = pa.array(np.append(first, len(bucket)), pa.int32())
            columns = [
                pa.array([lang] * len(first), pa.string()),
                pa.array(np.full(len(first), n, np.int32)),
                pa.array(bucket[first].astype(np.int32)),
                pa.ListArray.from_arrays(ends, names.cast(pa.large_string()).cast(pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in LISTS.split(", ")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            batch = sorted_rows(batch)
            texts = batch.column(2).to_pylist()
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                words, left = pieces_of(texts[a:b])
                strings = words.strings()
                runs = list(runs_of(batch.slice(a, b - a), words.before))
                seed = np.repeat(np.array([language_number(k[0]) for k, _, _ in runs]), [q - p for _, p, q in runs])
                for n, numbers, at in phrases_of(words.numbers(), left, seed):
                    chosen = is_candidate(cut_short(numbers))
                    numbers, at = numbers[chosen], at[chosen]
                    for (lang, _), p, q in runs:
                        part = slice(np.searchsorted(at, p), np.searchsorted(at, q))
                        if part.start < part.stop:
                            tally = held.setdefault((lang, n), Tally())
                            tally.add(numbers[part], at[part], lambda some: spelled(strings, some, n))
                if sum(len(t.seen) for t in held.values()) >= COUNTED_HELD:
                    yield from close(held)
                    held = {}
        yield from close(held)
        release()

    def add(table: pa.Table) -> pa.Table:
        lists = [pa.concat_arrays([c.flatten() for c in table.column(n).chunks]) for n in ("phrases", "counts")]
        summed = pa.table(lists, names=["phrase", "n"]).group_by("phrase").aggregate([("n", "sum")])
        many = summed.filter(pc.greater_equal(summed.column("n_sum"), support))
        lang, words = (table.column(c)[0].as_py() for c in ("lang", "words"))
        return pa.table(
            {
                "lang": pa.array([lang] * len(many), pa.string()),
                "phrase": many.column("phrase"),
                "words": pa.array(np.full(len(many), words, np.int32)),
                "f": many.column("n_sum"),
            }
        )

    parts = own.mapInArrow(count, LISTS)
    return parts.groupBy("lang", "words", "bucket").applyInArrow(add, "lang string, phrase string, words int, f bigint")


def words_from(phrase: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def scored(counts: DataFrame, taken_in: int = TAKEN_IN, scale: int = SCALE) -> DataFrame:
    """lang, phrase, a, l, r, score: the phrases of two words or more that no longer one takes in, by their weakest cut."""
    candidate = counts.where("words >= 2")
    cuts = candidate.select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    parts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        words_from(F.col("phrase"), F.lit(1), F.col("k")).alias("head"),
        words_from(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    known = counts.select("lang", F.col("phrase").alias("part"), "f")
    heads = known.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("part").alias("tail"), F.col("f").alias("r"))
    both = parts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr(f"cast((cast({scale} as decimal(20,0)) * cast(a as decimal(18,0))) div (l + r) as bigint)")
    weakest = (
        both.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    inner = candidate.where("words > 2").select(
        "lang", "phrase", "words", F.col("f").alias("longer"), F.explode(lengths).alias("n")
    )
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1))).select(
        "lang", words_from(F.col("phrase"), F.col("at"), F.col("n")).alias("phrase"), "longer"
    )
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * taken_in)
    return weakest.join(longest, ["lang", "phrase"], "left").where(alone).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    shards: int = SHARDS,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    words_per_group: int = WORDS_PER_GROUP,
    total_bits: int = membership.BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by score.

    ``a`` counts the phrase, ``l`` and ``r`` its first part and the rest at the cut that scores lowest,
    score = floor(2,000,000 a / (l + r)); ``n`` counts all words of the language.
    """
    own = owned(docs, lang_col, text_col, id_col, shards)
    share = shares(own, support)
    words = share.select("_lang", "n").distinct()
    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = min(1 << 24, total // (shards * words_per_group) + 1)
    found = keep(mined(local_counts(own, buckets), share), "shard-phrases")
    numbers = keep(candidates(found, support), "candidates")
    bits = own.sparkSession.sparkContext.broadcast(membership.filter_of(numbers, total_bits))
    buckets = min(1 << 24, numbers.count() // PHRASES_PER_GROUP + 1)
    counts = keep(
        counted(own, lambda x: membership.may_hold(bits.value, x, total_bits), support, buckets), "phrase-counts"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    names = words.select(F.col("_lang").alias("lang"), "n")
    return ranked.join(broadcast_if_small(names), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
