"""Namespaces, table sinks and scans, manifests, snapshots by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import namespace
from docloom.session import new_folder


def current_namespace(spark: SparkSession) -> str:
    """The session user's namespace, read as a one-row query."""
    return spark.range(1).select(namespace(F.current_user()).alias("ns")).first()["ns"]


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{where}")
    return name


def scratch_schema(spark: SparkSession, name: str = "docloom_work") -> str:
    """A schema whose tables live in the shared work folder."""
    return create_schema(spark, name, new_folder(spark, name))


def overwrite_table(df: DataFrame, table: str) -> DataFrame:
    """Replace ``table``, schema included, and return a scan of it."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.read.table(table)


def overwrite_counted(df: DataFrame, table: str) -> tuple[DataFrame, int]:
    """As ``overwrite_table``, with the row count observed during the write itself."""
    seen = Observation()
    out = overwrite_table(df.observe(seen, F.count(F.lit(1)).alias("n")), table)
    return out, seen.get["n"]


def last_wins(df: DataFrame, key: str, order: Column | str) -> DataFrame:
    """One row per key: the one with the greatest ``order``.

    An aggregate rather than a window: map tasks reduce a hot key to one row
    before anything is shuffled.
    """
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), order).alias("_best")
    return df.groupBy(key).agg(best).select(key, "_best.*").select(*df.columns)
