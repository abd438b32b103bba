"""Packing of documents into sequences: best fit planned over a histogram of lengths.

Documents become token ids, longer ones are cut into pieces, and only the number of
pieces of each length goes to the driver: at most ``capacity`` counts. Best fit runs
over those counts - a step places all pieces of a length that fit the same kind
of gap - and yields slots, ranges of ranks within a length. Pieces are ranked within
their length by the tasks that made them and join their slots.

Null texts count as empty: a document is at least its end id. Null or repeated ids are
documents of their own. An empty table gives no piece. Only the two named columns are
read, so further columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import vocab
from docloom.llm.storage import keep
from docloom.llm.worker import release
from docloom.llm.words import slices
from docloom.session import broadcast_if_small

CAPACITY = 1024
END = 2


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of every piece; all but a document's first are full."""
    pieces = -(-sizes // capacity)
    document = np.repeat(np.arange(len(sizes)), pieces)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = sizes - (pieces - 1) * capacity
    start = np.where(piece == 0, 0, first[document] + (piece - 1) * capacity)
    return document, piece, start, np.where(piece == 0, first[document], capacity)


def binary_lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Neighbouring ranges of ``flat`` that end at ``ends`` as binary values."""
    offsets = np.concatenate([[0], ends * flat.itemsize])
    kind = pa.binary() if offsets[-1] < 2**31 else pa.large_binary()
    buffers = [None, pa.py_buffer(offsets.astype(np.int32 if kind == pa.binary() else np.int64)), pa.py_buffer(flat)]
    return pa.Array.from_buffers(kind, len(ends), buffers)


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, piece, start, length, ids (little-endian unsigned 32-bit), part, nth: the pieces, not yet placed.

    ``nth`` numbers the pieces of one length that one task, ``part``, has made.
    """
    schema = T.StructType(
        [docs.schema[id_col]]
        + [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()))]
        + [T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = vocab.texts_of(batch.column(1))
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                ids, before = vocab.byte_encode(path, texts[a:b])
                ids = np.insert(ids.astype(np.uint32), before[1:], np.uint32(end))
                document, piece, start, length = cut(np.diff(before) + 1, capacity)
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts - made, counts)
                made += counts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(document)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        binary_lists(ids, np.cumsum(length)).cast(pa.binary()),
                        pa.array(np.full(len(length), part), pa.int32()),
                        pa.array(nth),
                    ],
                    names=schema.names,
                )
        release()

    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, pieces, first sequence, pieces per sequence, offset) by best fit over counts.

    Lengths go from long to short; each fills the smallest gaps that hold it, as
    often as they do, before new sequences are begun. Sequences with
    equal gaps are one range, so the steps depend on the number of lengths and
    not on that of documents.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    slots, begun = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def fill(gap: int, low: int, many: int) -> int:
            """Fill up to ``many`` sequences from ``low`` on; the number of those touched."""
            nonlocal rank, left
            each, touched = gap // length, 0
            for per, sequences in ((each, min(many, left // each)), (left % each, 1)):
                if not per or not sequences or touched + sequences > many or left < per * sequences:
                    continue
                slots.append((length, rank, per * sequences, low + touched, per, capacity - gap))
                if gap > per * length:
                    gaps[gap - per * length].append((low + touched, sequences))
                rank, left, touched = rank + per * sequences, left - per * sequences, touched + sequences
            return touched

        for gap in sorted(g for g in gaps if g >= length):
            if not left:
                break
            ranges = gaps.pop(gap)
            for i, (low, many) in enumerate(ranges):
                touched = fill(gap, low, many) if left else 0
                if touched < many:
                    gaps[gap].append((low + touched, many - touched))
        if left:
            begun += fill(capacity, begun, -(-left // (capacity // length)))
    return slots


def place(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``made`` (as ``pieces`` gives it, written down) with sequence_id and offset.

    Ranks within a length are a task's own number plus the pieces of
    that length in earlier tasks. The slots are few however many documents there
    are, which bounds their broadcast.
    """
    spark = made.sparkSession
    sizes = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    names = "length bigint, rank_from bigint, pieces bigint, sequence bigint, per bigint, at bigint"
    slots = F.broadcast(spark.createDataFrame(plan(counts, capacity), names))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # a few numbers per task and length: broadcast while they are, so that no token ids are shuffled
    before = broadcast_if_small(keep(before, "ranks-before"))
    ranked = made.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    inside = (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_from") + F.col("pieces"))
    nth = F.col("rank") - F.col("rank_from")
    sequence = F.col("sequence") + F.floor(nth / F.col("per"))
    return (
        ranked.join(slots.withColumnRenamed("length", "slot_length"), (F.col("length") == F.col("slot_length")) & inside)
        .withColumn("sequence_id", sequence)
        .withColumn("offset", F.col("at") + nth % F.col("per") * F.col("length"))
        .select([c for c in made.columns if c not in ("part", "nth")] + ["sequence_id", "offset"])
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """id, piece, start, length, ids, sequence_id, offset: all documents in sequences of ``capacity`` tokens."""
    return place(keep(pieces(docs, path, capacity, **options), "pieces"), capacity)
