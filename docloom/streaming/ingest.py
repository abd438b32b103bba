"""Incremental ingest: only new files are chunked."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.chunk import gold
from docloom.sources.files import FILE_SCHEMA


def stream_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The binary file scan as a stream of newly arrived files."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )


def stream_gold(
    arriving: DataFrame,
    to_silver: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    splitter: Callable[[Column], Column] | None = None,
) -> None:
    """Chunk everything that has arrived since the last run, then stop.

    Each micro-batch replaces its own folders ``batch_id=N``, so a batch that
    is repeated after a failure leaves the same rows. The paths of a batch are
    kept beside its chunks: a document that lost its text has a path but no chunk.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        silver_df = to_silver(batch)
        part = f"batch_id={batch_id}"
        silver_df.select("path").distinct().write.mode("overwrite").parquet(os.path.join(out, "paths", part))
        gold(silver_df, splitter).write.mode("overwrite").parquet(os.path.join(out, "chunks", part))

    query = (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(versions: DataFrame, paths: DataFrame) -> DataFrame:
    """Of each path only the chunks of its newest batch.

    ``paths`` is (path, batch_id); the newest batch per path is an aggregate of
    these two narrow columns, and chunks are joined to it, so a path with very
    many chunks can be split.
    """
    newest = paths.groupBy("path").agg(F.max("batch_id").alias("batch_id"))
    return versions.join(newest, ["path", "batch_id"], "left_semi").drop("batch_id")


def read_gold(spark: SparkSession, out: str) -> DataFrame:
    """All streamed chunks, re-ingested paths resolved to their newest version."""
    return latest(spark.read.parquet(os.path.join(out, "chunks")), spark.read.parquet(os.path.join(out, "paths")))
