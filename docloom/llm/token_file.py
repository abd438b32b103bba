"""Token files: ids by frequency in one to four bytes, control bytes apart, read by table lookup.

Documents are sorted by id over the whole table and encoded in that order. A file holds
documents up to a number of tokens. Its ids are replaced by their rank
among the file's ids, most frequent first, so that frequent ones take one byte;
two bits per id in the control bytes say how many bytes it takes. Every fourth id starts
a control byte, whose four lengths a reader looks up in a table.

File: ``MAGIC``; the counts of documents, tokens, different ids and data bytes and
the CRC of what follows; validity of document ids; document ids; tokens per
document; ids by rank; control bytes; data bytes. All numbers are little-endian.

Null texts are empty and keep their end id. Null document ids come first; rows with equal
ids follow each other in the order of a hash of their texts. An empty table gives no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import vocab
from docloom.llm.packing import END, binary_lists
from docloom.llm.storage import keep
from docloom.llm.worker import release
from docloom.llm.words import slices
from docloom.session import new_folder
from docloom.sources.blobs import open_file, write_file

MAGIC = b"TOKF0001"
HEADER = "<8sQQQQI"
TOKENS_PER_FILE = 1_500_000
READERS = 10_000
#: Lengths of the four ids of every control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by falling frequency, then by id; the rank of each of ``ids``)."""
    counts = np.bincount(ids)
    order = np.lexsort((np.arange(len(counts)), -counts))[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[order] = np.arange(len(order))
    return order.astype(np.uint32), rank[ids]


def to_bytes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    length = 1 + (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    padded = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    padded[: len(numbers)] = length - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    ends = np.cumsum(length, dtype=np.int64)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(4):
        has = slice(None) if i == 0 else length > i
        data[(ends - length)[has] + i] = numbers[has] >> (8 * i)
    return control, data


def from_bytes(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of ``to_bytes``."""
    length = LENGTHS[control].ravel()[:n]
    start = np.cumsum(length, dtype=np.int64) - length
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    numbers = padded[start].astype(np.uint32)
    for i in range(1, int(length.max(initial=1))):
        numbers |= np.where(length > i, padded[start + i], 0).astype(np.uint32) << np.uint32(8 * i)
    return numbers


def file_bytes(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> list[bytes]:
    table, rank = ranked(ids)
    control, data = to_bytes(rank)
    valid = doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    parts = [valid, doc_ids.fill_null(0).to_numpy().astype("<i8"), sizes.astype("<u8"), table.astype("<u4"), control, data]
    body = b"".join(p.tobytes() for p in parts)
    return [struct.pack(HEADER, MAGIC, len(doc_ids), len(ids), len(table), len(data), zlib.crc32(body)), body]


def file_rows(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(document ids, tokens per document, ids in a row) of a file; an error if it fails its checks."""
    with open_file(path) as f:
        magic, n_docs, n_tokens, n_ids, n_data, crc = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
        body = f.read()
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError(f"{path} is no token file or damaged")
    fields, at = [], 0
    for kind, n in (("u1", n_docs), ("<i8", n_docs), ("<u8", n_docs), ("<u4", n_ids), ("u1", -(-n_tokens // 4)), ("u1", n_data)):
        fields.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    valid, doc_ids, sizes, table, control, data = fields
    ids = table[from_bytes(control, data, n_tokens)] if n_tokens else np.empty(0, np.uint32)
    return pa.array(doc_ids, pa.int64(), mask=valid == 0), sizes.astype(np.int64), ids


def write(
    docs: DataFrame,
    path: str,
    folder: str | None = None,
    end: int = END,
    tokens_per_file: int = TOKENS_PER_FILE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """part, nth, file, n_docs, n_tokens, first: the files written, in order; ``first`` counts the tokens before a file.

    Only the id and the text of a row are sorted, by range, so that part i holds smaller
    ids than part i + 1; equal ids may be split between parts. A part's files are begun
    whenever the last is full, so a task holds one file's tokens.
    """
    folder = folder or new_folder(docs.sparkSession, "token-files")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, attempt = TaskContext.get().partitionId(), 0, TaskContext.get().taskAttemptId()
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            # a repeated task writes files of its own; the list has those of the one that counts
            name = f"{folder}/{part:06d}-{nth:04d}-{attempt}.tokens"
            doc_ids = pa.concat_arrays([h[0] for h in held])
            write_file(name, file_bytes(doc_ids, *(np.concatenate([h[i] for h in held]) for i in (1, 2))))
            row = [[part], [nth], [name], [len(doc_ids)], [tokens]]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], names=["part", "nth", "file", "n_docs", "n_tokens"]
            )

        for batch in batches:
            texts = vocab.texts_of(batch.column(1))
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                ids, before = vocab.byte_encode(path, texts[a:b])
                ids = np.insert(ids.astype(np.uint32), before[1:], np.uint32(end))
                held.append((batch.column(0).slice(a, b - a), np.diff(before) + 1, ids))
                tokens += len(ids)
                if tokens >= tokens_per_file:
                    yield close()
                    held, tokens, nth = [], 0, nth + 1
        if held:
            yield close()
        release()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    made = ordered.mapInArrow(encode, "part int, nth int, file string, n_docs bigint, n_tokens bigint")
    files = keep(made, "token-file-list")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return files.withColumn("within", within).join(parts, "part").select(
        *files.columns, (F.col("before") + F.col("within")).alias("first")
    )


def read(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids (little-endian unsigned 32-bit): the documents of ``files`` (file, first)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids, sizes, ids = file_rows(name)
                ends = np.cumsum(sizes)
                for a, b in slices(sizes):
                    low = int(ends[a - 1]) if a else 0
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_ids.slice(a, b - a),
                            pa.array(first + ends[a:b] - sizes[a:b], pa.int64()),
                            pa.array(sizes[a:b], pa.int64()),
                            binary_lists(ids[low : ends[b - 1]], ends[a:b] - low).cast(pa.binary()),
                        ],
                        names=[id_col, "start", "n_tokens", "ids"],
                    )

    readers = min(READERS, max(1, files.count()))
    # one file after the other to each reader: a hash of names would leave many without any
    dealt = files.select("file", "first").repartition(readers)
    return dealt.mapInArrow(decode, f"{id_col} bigint, start bigint, n_tokens bigint, ids binary")
