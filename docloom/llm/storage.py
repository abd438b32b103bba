"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.session import new_folder

ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold 1,000 rows where they would hold Spark's default of 10,000: rows are whole texts."""
    if spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "1000")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once, compressed, to the shared folder and read it back: its lineage ends there."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
