"""Exact duplicates by counting quotient filters and byte verification.

A text is compared without white space. Every partition builds counting quotient filters
of its texts' 64-bit fingerprints, one per block of leading bits: the next
bits, the quotient, name a home slot, whose run holds the remainders in order with a
count each. Filters of a block merge without loss, since runs are sorted. Texts
whose fingerprint counts more than one, and no others, are then grouped by their bytes; map tasks
fold copies first, so a large group of copies is as cheap as a small one.

Null texts are empty texts; all empty texts are equal. Of equal texts the one with the
most code points stays, then the one with the smallest id (null ids last), and of
repeated rows exactly one. Ids may be numbers or strings. An empty table gives no rows. Only the named columns are read. Every row gives a row.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.filtering import key_of, stay
from docloom.llm.storage import keep
from docloom.llm.token_file import from_bytes, to_bytes
from docloom.session import broadcast_if_small

WHITE = r"[\x20\x09-\x0D]+"
#: A filter has about as many quotients as fingerprints, so that its bytes follow what it holds.
MOST_QUOTIENT_BITS = 16
FINGERPRINTS_PER_BLOCK = 1 << 16
FINGERPRINTS_PER_FILTER = 4_000_000
#: Block, its bits, quotient bits, slots.
HEAD = "<QBBI"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def counted(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different fingerprints and their summed counts."""
    order = np.argsort(fingerprints, kind="stable")
    sorted_ = fingerprints[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else order
    ones = np.ones(len(order), np.int64) if counts is None else counts[order]
    return sorted_[first], np.add.reduceat(ones, first) if len(first) else ones


def filter_bytes(fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> bytes:
    """A filter of sorted different fingerprints that share their first ``block_bits`` bits.

    Metadata as in a quotient filter: a bit per quotient says whether it occurs, a bit per
    slot whether a run ends there. Counts take one to four bytes each, larger ones
    further slots of the same remainder.
    """
    most = (1 << 32) - 1
    slots = np.maximum(1, -(-counts // most))
    fingerprints = np.repeat(fingerprints, slots)
    last = np.cumsum(slots) - 1
    each = np.full(len(fingerprints), most, np.int64)
    each[last] = counts - (slots - 1) * most
    tail = (fingerprints << np.uint64(block_bits)) >> np.uint64(block_bits)
    quotient_bits = min(MOST_QUOTIENT_BITS, len(fingerprints).bit_length())
    shift = np.uint64(64 - block_bits - quotient_bits)
    quotient = (tail >> shift).astype(np.int64)
    occupied = np.bincount(quotient, minlength=1 << quotient_bits) > 0
    run_end = np.append(quotient[1:] != quotient[:-1], True)[: len(quotient)]
    remainder = tail & ((np.uint64(1) << shift) - np.uint64(1))
    control, data = to_bytes(each.astype(np.uint32))
    block = int(fingerprints[0] >> np.uint64(64 - block_bits)) if block_bits else 0
    parts = [np.packbits(occupied), np.packbits(run_end), remainder.astype("<u8"), control, data]
    return struct.pack(HEAD, block, block_bits, quotient_bits, len(fingerprints)) + b"".join(p.tobytes() for p in parts)


def filter_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints, in order, and counts that a filter holds."""
    block, block_bits, quotient_bits, n = struct.unpack_from(HEAD, data)
    at = struct.calcsize(HEAD)
    fields = []
    for kind, size in (("u1", -(-(1 << quotient_bits) // 8)), ("u1", -(-n // 8)), ("<u8", n), ("u1", -(-n // 4))):
        fields.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    occupied, run_end, remainder, control = fields
    counts = from_bytes(control, np.frombuffer(data, "u1", -1, at), n).astype(np.int64)
    ends = np.unpackbits(run_end, count=n)
    run = np.cumsum(ends) - ends
    quotient = np.flatnonzero(np.unpackbits(occupied, count=1 << quotient_bits))[run].astype(np.uint64)
    top = np.uint64(block << (64 - block_bits) if block_bits else 0)
    shift = np.uint64(64 - block_bits - quotient_bits)
    return top | (quotient << shift) | remainder, counts


def filters(fingerprints: DataFrame, block_bits: int) -> DataFrame:
    """block, filter: the filters of each partition of a bigint column."""

    def close(held: list[np.ndarray]) -> pa.RecordBatch:
        prints, counts = counted(np.concatenate(held).astype(np.uint64))
        blocks = prints >> np.uint64(64 - block_bits) if block_bits else np.zeros(len(prints), np.uint64)
        first = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        data = [
            filter_bytes(prints[a:b], counts[a:b], block_bits) for a, b in zip(first, [*first[1:], len(prints)])
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[first].astype(np.int64)), pa.array(data, pa.binary())], names=["block", "filter"]
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            n += batch.num_rows
            if n >= FINGERPRINTS_PER_FILTER:
                yield close(held)
                held, n = [], 0
        if n:
            yield close(held)

    return fingerprints.mapInArrow(build, "block bigint, filter binary")


def repeated(fingerprints: DataFrame, rows: int) -> DataFrame:
    """fp, n: the fingerprints that occur more than once among about ``rows``, and how often."""
    block_bits = min(24, max(0, (rows // FINGERPRINTS_PER_BLOCK).bit_length()))

    def merge(table: pa.Table) -> pa.Table:
        held = [filter_counts(f) for f in table.column("filter").to_pylist()]
        prints, counts = counted(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        many = counts > 1
        return pa.table({"fp": prints[many].view(np.int64), "n": counts[many]})

    return filters(fingerprints, block_bits).groupBy("block").applyInArrow(merge, "fp bigint, n bigint")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256, _key: the group of equal texts of every row, and whether it stays.

    ``_key`` is a digest of the id and the whole text.
    """
    text = normalised(F.col(text_col))
    rows = keep(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(id_col).alias("_id"),
            F.coalesce(F.length(text_col), F.lit(0)).alias("_points"),
            F.xxhash64(text).alias("_fp"),
            F.sha2(text, 256).alias("_sha"),
            key_of(id_col, text_col).alias("_key"),
        ),
        "fingerprints",
    )
    many = keep(repeated(rows.select("_fp"), rows.count()), "repeated").select(F.col("fp").alias("_fp"))
    wanted = broadcast_if_small(many)
    best = F.min(F.struct((-F.col("_points")).alias("points"), F.col("_id").isNull().alias("unknown"), "_id", "_row"))
    same_digest = (
        rows.join(wanted, "_fp", "left_semi")
        .groupBy("_fp", "_sha")
        .agg(F.count(F.lit(1)).alias("_size"), best.alias("_best"))
    )
    same_bytes = (
        docs.select(F.xxhash64(text).alias("_fp"), text.alias("_text"))
        .join(wanted, "_fp", "left_semi")
        .groupBy("_fp", "_text")
        .agg(F.count(F.lit(1)).alias("_size"))
        .where("_size > 1")
        .select("_fp", F.sha2("_text", 256).alias("_sha"), "_size")
    )
    verified = keep(same_digest.join(same_bytes, ["_fp", "_sha", "_size"]), "equal-texts").select(
        "_fp",
        "_sha",
        "_size",
        F.col("_best._id").alias("_keep"),
        F.col("_best._row").alias("_keep_row"),
    )
    grouped = F.col("_size").isNotNull()
    return rows.join(verified, ["_fp", "_sha"], "left").select(
        F.col("_id").alias(id_col),
        F.when(grouped, F.col("_keep")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        (~grouped | (F.col("_keep_row") == F.col("_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        "_key",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return stay(docs, groups(docs, id_col, text_col), key_of(id_col, text_col))
