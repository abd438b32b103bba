"""Single files in the shared folders, written by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def _found(path: str):
    """(file system, path in it); a path without a scheme is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else f"file://{path}")


def listed(folder: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no such folder."""
    from pyarrow import fs

    system, place = _found(folder)
    return sorted(x.base_name for x in system.get_file_info(fs.FileSelector(place, allow_not_found=True)))


def write_file(path: str, parts: list) -> None:
    """Write a file whole or not at all: under another name first, so that a lost or repeated task leaves no half.

    A file of that name, as a repeated task finds it, gives way.
    """
    from pyarrow import fs

    system, place = _found(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    half = f"{place}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(half) as out:
        for part in parts:
            out.write(part)
    if system.get_file_info(place).type != fs.FileType.NotFound:
        system.delete_file(place)
    system.move(half, place)


def open_file(path: str):
    """A file that can be read and sought."""
    system, place = _found(path)
    return system.open_input_file(place)


def land(files: DataFrame, folder: str) -> int:
    """Write each row (name, content) as a file below ``folder``; the number of files. Names are unique."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                write_file(f"{folder}/{name}", [content or b""])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    done = files.select("name", "content").mapInArrow(write, "n bigint")
    return done.groupBy().sum("n").first()[0] or 0
