"""File sources: binary scan and landing status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file below ``path`` (recursive): path, modificationTime, length, content.

    The glob is matched against file names and is case-sensitive. Dropping
    ``content`` keeps the scan from opening the files at all.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def landing_status(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """name, url, status, landed_files, landed_bytes for every manifest entry.

    ``landed`` has (name, length), one row per file. Lengths are summed per
    name before the join, so a name with very many files is no hot key.
    """
    sizes = landed.groupBy("name").agg(
        F.count(F.lit(1)).alias("landed_files"), F.sum("length").alias("landed_bytes")
    )
    return manifest.join(sizes, "name", "left").select(
        "name",
        "url",
        F.when(F.col("landed_files").isNull(), "MISSING").otherwise("LANDED").alias("status"),
        F.coalesce("landed_files", F.lit(0)).alias("landed_files"),
        F.coalesce("landed_bytes", F.lit(0)).alias("landed_bytes"),
    )
