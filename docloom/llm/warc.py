"""WARC archives: writing with revisits, and a reader that salvages what damage has left.

Writing: a page becomes a response record, a gzip member of its own, or, if its payload equals
that of a page with a larger id, a revisit of that page's record without the payload.

Reading: a record counts if its member inflates and passes its CRC, its headers parse, its length,
block digest and payload digest hold and its end is where it should be. After a failed check the
reader searches on, from the next byte, for a gzip member or a version line where a whole record
can be read; the bytes passed over are a row of their own. Files are read in chunks; a
task holds one record, however long the file.

Null payloads are empty ones. Null ids are written as ``none`` and read as null; a page with a
null id is the response only if its group has no other. Rows repeating the group's largest id are
all responses. Only the named columns are read. Every row gives a record, an empty table no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.storage import keep
from docloom.session import broadcast_if_small, new_folder
from docloom.sources.blobs import open_file, write_file

FILE_BYTES = 32 * 1024 * 1024
ROW_BYTES = 8 * 1024 * 1024
CHUNK = 256 * 1024
HEAD_BYTES = 1024 * 1024
READERS = 10_000
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
VERSIONS = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"
UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: str, uri: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None) -> bytes:
    """A response record, or without a payload a revisit record of a payload of ``size`` bytes."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload or b"")
    safe = UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", uri or "")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{page}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", safe),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_32(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write(
    pages: DataFrame,
    folder: str | None = None,
    least: int = 0,
    file_bytes: int = FILE_BYTES,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """file, n_records, n_bytes: the archives written. Payloads of fewer than ``least`` bytes are never revisited."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(uri_col).cast("string").alias("uri"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    alike = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND keep IS NOT NULL")
        .select("digest", "keep")
    )
    marked = rows.join(broadcast_if_small(keep(alike, "equal-payloads")), "digest", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    to_write = marked.select(
        F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("id"),
        "uri",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.octet_length("payload").alias("size"),
        "digest",
        F.col("keep").cast("string").alias("keep"),
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, held, size = TaskContext.get(), 0, [], 0
        # a repeated task writes files of its own; the list below has those of the one that counts
        name_of = f"{folder}/{task.partitionId():06d}-{{:04d}}-{task.taskAttemptId()}.warc.gz".format

        def close() -> pa.RecordBatch:
            name = name_of(nth)
            write_file(name, held)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64())],
                names=["file", "n_records", "n_bytes"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                page, uri, body, length, digest, refers_to = (column[i].as_py() for column in batch.columns)
                name = base64.b32encode(bytes.fromhex(digest)).decode()
                held.append(member(record(page, uri, body, length, name, refers_to)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
                    nth, held, size = nth + 1, [], 0
        if held:
            yield close()

    return keep(to_write.mapInArrow(archive, "file string, n_records bigint, n_bytes bigint"), "warc-files")


class Damaged(Exception):
    """A check failed."""


class Plain:
    """Bytes of a file from ``at`` on."""

    #: Whether a check of its own vouches for all that is read.
    vouched = False

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size = file, at, size
        self.held = b""

    def more(self) -> bool:
        """Hold one chunk more; False at the end."""
        if self.at >= self.size:
            return False
        self.file.seek(self.at)
        data = self.file.read(min(CHUNK, self.size - self.at))
        self.at += len(data)
        self.held += data
        return bool(data)

    @property
    def reached(self) -> int:
        return self.at - len(self.held)

    def until(self, mark: bytes, most: int) -> bytes:
        """Everything up to and with ``mark``; beyond ``most`` bytes only in a member that begins with a version line."""
        parts, have = [], 0
        while (found := self.held.find(mark)) < 0:
            if most and have + len(self.held) > most:
                if not (self.vouched and VERSIONS.match(b"".join([*parts, self.held[: len(VERSION)]]))):
                    raise Damaged("headers do not end")
                most = 0
            cut = max(0, len(self.held) - len(mark) + 1)
            parts.append(self.held[:cut])
            have += cut
            self.held = self.held[cut:]
            if not self.more():
                raise Damaged("headers do not end")
        parts.append(self.held[: found + len(mark)])
        self.held = self.held[found + len(mark) :]
        return b"".join(parts)

    def take(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n:
            self.held = b""
            if not self.more():
                raise Damaged("the record is cut off")
            parts.append(self.held)
            have += len(self.held)
        data = b"".join(parts)
        self.held = data[n:]
        return data[:n]

    def at_end(self) -> bool:
        return not self.held and not self.more()


class Inflated(Plain):
    """The content of the gzip member at ``at``; ``at`` moves on through the file."""

    vouched = True

    def __init__(self, file, at: int, size: int):
        super().__init__(file, at, size)
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        before = len(self.held)
        while not self.inflate.eof and len(self.held) == before:
            try:
                # what is left of the last chunk, or held back by the bound on output
                data = self.inflate.decompress(self.inflate.unconsumed_tail, CHUNK)
                if not data and not self.inflate.eof:
                    self.file.seek(self.at)
                    raw = self.file.read(min(CHUNK, self.size - self.at))
                    if not raw:
                        raise Damaged("the member is cut off")
                    self.at += len(raw)
                    data = self.inflate.decompress(raw, CHUNK)
            except zlib.error as e:
                raise Damaged(f"the member does not inflate ({e})") from e
            self.held += data
            if self.inflate.eof:
                self.at -= len(self.inflate.unused_data)
        return len(self.held) > before

    @property
    def reached(self) -> int:
        return self.at if self.inflate.eof else self.at - len(self.inflate.unconsumed_tail)


def headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def checked(digest: str | None, data: bytes, what: str) -> None:
    """SHA-1 digests are compared, others cannot be."""
    if digest and digest.lower().startswith("sha1:") and digest[5:].upper() != sha1_32(data):
        raise Damaged(f"the {what} digest differs")


def one_record(stream: Plain) -> dict:
    """The record at the head of ``stream``."""
    head = stream.until(b"\r\n\r\n", HEAD_BYTES)
    if not VERSIONS.match(head):
        raise Damaged("no version line")
    fields = headers(head)
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or len(length) > 18:
        raise Damaged("no content length")
    if type(stream) is Plain and int(length) > stream.size - stream.reached:
        raise Damaged("the record is cut off")
    block = stream.take(int(length))
    if stream.take(4) != b"\r\n\r\n":
        raise Damaged("the record does not end where it should")
    checked(fields.get("warc-block-digest"), block, "block")
    kind = fields.get("warc-type")
    http, payload, size = {}, block, len(block)
    if "application/http" in fields.get("content-type", ""):
        start, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("HTTP headers do not end")
        http, size = headers(start), len(payload)
    if kind == "revisit":
        size, payload = int(http.get("content-length") or 0), None
    else:
        checked(fields.get("warc-payload-digest"), payload, "payload")
    named = {k: (fields.get(k) or "").strip("<>") for k in ("warc-record-id", "warc-refers-to")}
    return {
        "record_id": named["warc-record-id"] or None,
        "record_type": kind,
        "uri": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "refers_to": named["warc-refers-to"] or None,
        "payload": payload,
    }


def next_start(file, at: int, size: int) -> int:
    """Where a member or a version line may begin, from ``at`` on; the file's end if nowhere."""
    longest = len(VERSION)
    while at < size:
        file.seek(at)
        data = file.read(min(CHUNK, size - at))
        if found := START.search(data):
            return at + found.start()
        if at + len(data) >= size:
            break
        at += max(1, len(data) - longest + 1)
    return size


def records_at(file, at: int, size: int) -> Iterator[dict | int]:
    """The records of the member, or the plain record, at ``at``, then where it ends.

    A member's last record is given only when the member's own check has passed.
    """
    file.seek(at)
    packed = file.read(len(MAGIC)) == MAGIC
    stream = (Inflated if packed else Plain)(file, at, size)
    start, waiting = at, None
    while True:
        found = one_record(stream)
        if waiting:
            yield waiting
        waiting = found | {"offset": start, "n_bytes": stream.reached - start}
        start = stream.reached
        if not packed or stream.at_end():
            break
    yield waiting | {"n_bytes": stream.reached - waiting["offset"]}
    yield stream.reached


def rows_of(file, size: int) -> Iterator[dict]:
    """Records and quarantined gaps, in the order of the file."""
    at, gap, reason = 0, None, ""
    while at < size:
        good = at
        try:
            for found in records_at(file, at, size):
                if isinstance(found, int):
                    at = found
                    continue
                if gap is not None:
                    yield {"offset": gap, "n_bytes": found["offset"] - gap, "reason": reason}
                    gap = None
                yield found
                good = found["offset"] + found["n_bytes"]
        except Damaged as e:
            if gap is None:
                gap, reason = good, str(e)
            at = next_start(file, max(at, good - 1) + 1, size)
    if gap is not None:
        yield {"offset": gap, "n_bytes": size - gap, "reason": reason}


ROWS = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("n_bytes", pa.int64()),
        ("reason", pa.string()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("uri", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read(files: DataFrame) -> DataFrame:
    """A row per record and per gap of the archives in column ``file``: gaps have a ``reason``, records none."""

    def salvage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                with open_file(name) as f:
                    for row in rows_of(f, f.size()):
                        held.append(row | {"file": name})
                        size += len(row.get("payload") or b"") + 500
                        if size >= ROW_BYTES:
                            yield pa.RecordBatch.from_pylist(held, ROWS)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, ROWS)

    kinds = ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else f.type}" for f in ROWS)
    readers = min(READERS, max(1, files.count()))
    return files.select("file").repartition(readers, "file").mapInArrow(salvage, kinds)


def pages_of(rows: DataFrame, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload: the records, ids as they were."""

    def page(column: str):
        return F.nullif(F.replace(F.col(column), F.lit(ID), F.lit("")), F.lit("none")).cast(id_type)

    return rows.where(F.col("reason").isNull()).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "payload",
    )
