"""The change feed of versioned gold snapshots as a streaming source, and an index that follows it.

``publish`` writes a snapshot, the changes since the one before, and last a marker, so that a version is seen
whole or not at all. The source's offset is a version: a stream reads the changes of all versions after the one it has
come to, file by file in its tasks. ``follow`` applies them to the index, a new folder per version; a batch
that is repeated after a failure reads the same versions and replaces the same folder.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from docloom.operators.index import apply_changes, change_feed
from docloom.sources.blobs import listed, open_file

FORMAT = "docloom_changes"
SCHEMA = "version int, path string, chunk_id string, change_type string"


def latest_version(folder: str) -> int:
    """The newest version up to which all are complete, 0 for none."""
    complete = {int(name) for name in listed(f"{folder}/complete") if name.isdigit()}
    newest = 0
    while newest + 1 in complete:
        newest += 1
    # the last marker may still be in the making
    while newest and "_SUCCESS" not in listed(f"{folder}/complete/{newest}"):
        newest -= 1
    return newest


def snapshot(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/gold/{version}")


def publish(gold: DataFrame, folder: str) -> int:
    """Write ``gold`` (path, chunk_id, chunked_text, ...) as the next version below ``folder``; its number."""
    spark = gold.sparkSession
    before = latest_version(folder)
    version = before + 1
    gold.write.mode("overwrite").parquet(f"{folder}/gold/{version}")
    new = snapshot(spark, folder, version)
    old = snapshot(spark, folder, before) if before else new.limit(0)
    change_feed(old, new).write.mode("overwrite").parquet(f"{folder}/changes/{version}")
    spark.createDataFrame([(version,)], "version int").write.mode("overwrite").parquet(f"{folder}/complete/{version}")
    return version


@dataclass
class ChangeFile(InputPartition):
    version: int
    path: str


class ChangeReader(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": latest_version(self.folder)}

    def partitions(self, start: dict, end: dict) -> list[ChangeFile]:
        found = []
        for version in range(start["version"] + 1, end["version"] + 1):
            place = f"{self.folder}/changes/{version}"
            found += [ChangeFile(version, f"{place}/{name}") for name in listed(place) if name.endswith(".parquet")]
        return found

    def read(self, partition: ChangeFile) -> Iterator[pa.RecordBatch]:
        with open_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches():
                version = pa.array([partition.version] * batch.num_rows, pa.int32())
                columns = [batch.column(name) for name in ("path", "chunk_id", "change_type")]
                yield pa.RecordBatch.from_arrays([version, *columns], names=["version", "path", "chunk_id", "change_type"])

    def commit(self, end: dict) -> None:
        """Versions stay, for other readers."""


class ChangeSource(DataSource):
    """``spark.readStream.format("docloom_changes").load(folder)``: version, path, chunk_id, change_type."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader(self.options["path"])


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changes of all versions below ``folder`` as a stream."""
    spark.dataSource.register(ChangeSource)
    return spark.readStream.format(FORMAT).load(folder)


def index_at(spark: SparkSession, out: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{out}/{version}")


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str) -> None:
    """Bring the index below ``out`` up to the newest version, then stop.

    However many versions a batch spans, the rows of ids they touch are read from the newest snapshot once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        span = batch.agg(F.min("version").alias("first"), F.max("version").alias("last")).first()
        if span["last"] is None:
            return
        new, before = snapshot(spark, folder, span["last"]), span["first"] - 1
        # versions without changes have no rows, so that the last index may be older than the version before
        while before and str(before) not in listed(out):
            before -= 1
        old = index_at(spark, out, before) if before else None
        apply_changes(old, new, batch).write.mode("overwrite").parquet(os.path.join(out, str(span["last"])))

    query = (
        read_changes(spark, folder)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest_index(spark: SparkSession, out: str) -> DataFrame:
    return index_at(spark, out, max(int(name) for name in listed(out) if name.isdigit()))
