"""Per-query ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hit_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    types = queries.schema["query_id"].dataType, corpus.schema["id"].dataType, T.DoubleType()
    return T.StructType([T.StructField(n, t) for n, t in zip(("query_id", "id", "score"), types)])


def top_k(scored: DataFrame, k: int, query: str = "query_id", tie: str = "id") -> DataFrame:
    """Keep the k best rows per query and number them from 1.

    Scores are compared at six decimals so that summation order cannot change
    a rank; Spark plans a partial group limit below the shuffle.
    """
    w = Window.partitionBy(query).orderBy(F.round("score", 6).desc(), F.col(tie))
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
