"""Session defaults, the shared work folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024


def build(app: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling switched on.

    Partition counts are left to the cluster (AQE coalesces or splits them);
    pass ``spark_sql_shuffle_partitions="8"`` and the like for local runs.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        b = b.master(master)
    for key, value in conf.items():
        b = b.config(key.replace("_", "."), value)
    return b.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine only.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    named = named or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        # a running session takes no new value for the setting itself
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """Where everything lies that this application writes for itself."""
    return os.path.join(work_dir(spark), "docloom", spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's folder; never reused, so retries cannot clash."""
    return os.path.join(own_folder(spark), f"{label}-{uuid.uuid4().hex}")


GENERATION = "spark.docloom.generation"
#: The codec of texts and postings that stay; by the default one they are some 1.4 times as large.
SMALL = "zstd"
#: Names of the tables that stores leave in the catalog.
STORED = ("postings_", "blocks_", "terms_")


def generation(spark: SparkSession) -> int:
    """How often this application has been cleaned: what was written before is gone."""
    return int(spark.conf.get(GENERATION, "0"))


def clean(spark: SparkSession) -> None:
    """Delete all that this application has written for itself, once nothing reads it any more.

    Results are lazy and read intermediates, so that only the application knows when; what
    it leaves has its id for a name. Stores go from the catalog, too.
    """
    for table in spark.catalog.listTables():
        if table.name.startswith(STORED) and not table.isTemporary:
            where = spark.sql(f"DESCRIBE FORMATTED `{table.name}`").where("col_name = 'Location'").first()
            if where and spark.sparkContext.applicationId in where["data_type"]:
                spark.sql(f"DROP TABLE `{table.name}`")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    spark.conf.set(GENERATION, str(generation(spark) + 1))


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the work folder, by ``codec`` if one is named, and read it back.

    Cuts lineage on durable storage, so a lost executor costs a re-read and not
    a re-run of model calls or Python chunking.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(column: Column, kind: T.DataType) -> Column:
    """The bytes of a value within its row, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            size = F.aggregate(column, F.lit(0).cast("bigint"), lambda n, x: n + _width(x, kind.elementType))
        else:
            size = 8 * F.size(column)
    elif isinstance(kind, T.MapType):
        keys, values = F.map_keys(column), F.map_values(column)
        size = _width(keys, T.ArrayType(kind.keyType)) + _width(values, T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = F.lit(0)
        for field in kind.fields:
            size = size + _width(column[field.name], field.dataType)
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size.cast("bigint"), F.lit(0)) + 8


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``, from one aggregate over it."""
    width = F.lit(16).cast("bigint")
    for field in df.schema.fields:
        width = width + _width(df[field.name], field.dataType)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"], row["b"] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when ``df``'s measured size is within ``limit``."""
    return F.broadcast(df) if measured(df)[1] <= limit else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` on all cores, by one shuffle, if its scan has fewer partitions than there are cores.

    Files that cannot be split leave most of a cluster idle; a scan that
    already fills it is passed on as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
