"""Vector search: exact and approximate nearest neighbours by cosine."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.rank import hit_schema, top_k
from docloom.functions.skew import left_join_unique
from docloom.functions.topk import CELLS, QUERIES, TopK
from docloom.session import BROADCAST_LIMIT, broadcast_if_small, materialise, measured

CORPUS_BLOCK = 50_000
QUERY_BLOCK = 4_096


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors; an error if they are not all of one length."""
    sizes = pc.unique(pc.list_value_length(column))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes.to_pylist())}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(flat.reshape(len(column), -1))


def _offer(best: TopK, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
    """Score blocks of queries against slices of rows, each block of scores small."""
    for first in range(0, len(queries), QUERIES):
        block = queries[first : first + QUERIES]
        step = max(1, CELLS // len(block))
        for at in range(0, len(rows), step):
            best.offer(block @ rows[at : at + step].T, ids[at : at + step], first)


def _score(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Each task scores its rows against all queries and emits k hits per query; no corpus shuffle."""
    spark = corpus.sparkSession
    local = queries.toArrow()
    if not local.num_rows:
        return spark.createDataFrame([], hit_schema(queries, corpus))
    shared = spark.sparkContext.broadcast(
        (np.asarray(local["query_id"].to_pylist()), matrix(local["v"].combine_chunks()))
    )
    name_type = local.schema.field("query_id").type

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = shared.value
        best = TopK(len(names), k)
        for batch in batches:
            if batch.num_rows:
                arrow_id = batch.column("id").type
                ids = np.asarray(batch.column("id").to_pylist())
                _offer(best, asked, matrix(batch.column("v")), ids)
        if best.ids is not None:
            yield best.batch(names, name_type, arrow_id)

    return corpus.mapInArrow(score, hit_schema(queries, corpus))


def _score_blocks(queries: DataFrame, corpus: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Block-wise scoring of the rows that agree on ``keys``.

    Both sides carry (``keys``, qb, cb); every group is one query block against
    one corpus block, both of bounded size however large a key is, and emits k
    hits per query.
    """

    schema = hit_schema(queries, corpus)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names, ids = left["query_id"].combine_chunks(), right["id"].combine_chunks()
        best = TopK(len(names), k)
        if len(names) and len(ids):
            queries = matrix(left["v"].combine_chunks())
            _offer(best, queries, matrix(right["v"].combine_chunks()), np.asarray(ids.to_pylist()))
        return pa.Table.from_batches([best.batch(np.asarray(names.to_pylist()), names.type, ids.type)])

    group = [*keys, "qb", "cb"]
    return queries.groupBy(*group).cogroup(corpus.groupBy(*group)).applyInArrow(score, schema)


def _blocked(df: DataFrame, key: str, own: str, own_n, other: str, other_n) -> DataFrame:
    """Put a row into one block of its own side and a copy next to each block of the other."""
    return df.withColumn(own, F.pmod(F.xxhash64(key), own_n)).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("bigint"), other_n - 1))
    )


def direction(bit: int, size: int) -> list[float]:
    """The direction whose side a vector lies on is the ``bit``-th bit of its buckets.

    Component j is the first eight hex digits of md5("bit:j") as a number from -1 to 1.
    """
    digits = [hashlib.md5(f"{bit}:{j}".encode()).hexdigest()[:8] for j in range(size)]
    return [int(d, 16) / 2**31 - 1 for d in digits]


def _bucketer(size: int, tables: int, width: int):
    """An Arrow function vector -> one bucket of ``width`` bits per table."""
    directions = np.array([direction(b, size) for b in range(tables * width)]).T
    powers = 1 << np.arange(width, dtype=np.int64)

    @F.arrow_udf("array<bigint>")
    def buckets(vectors: pa.Array) -> pa.Array:
        sides = (matrix(vectors) @ directions > 0).reshape(len(vectors), tables, width)
        return pa.FixedSizeListArray.from_arrays(pa.array((sides @ powers).ravel()), tables).cast(pa.list_(pa.int64()))

    return buckets


def fresh(df: DataFrame, key: str) -> DataFrame:
    """(key, v) under new column identities, so that a table can be searched with its own rows."""
    return df.where(F.col("v").isNotNull()).select(F.col(key).alias(key), F.col("v").alias("v"))


def knn_exact(queries: DataFrame, corpus: DataFrame, k: int = 5, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """query_id, id, score, rank: the k nearest of ``corpus`` (id, v) per query (query_id, v).

    A row per hit, so a query without a vector has none. Queries are broadcast; where they exceed
    ``limit`` bytes, blocks of them meet blocks of the corpus in one job. The corpus travels once for each block
    of queries, which are therefore as large as a task can hold, and cut into blocks for all cores.
    """
    queries, corpus = materialise(fresh(queries, "query_id"), "queries"), fresh(corpus, "id")
    size = measured(queries)[1]
    if size <= limit:
        return top_k(_score(queries, corpus, k), k)
    n_corpus, cores = corpus.count(), corpus.sparkSession.sparkContext.defaultParallelism
    blocks = 2 * size // BROADCAST_LIMIT + 1, max(n_corpus // CORPUS_BLOCK + 1, min(cores, n_corpus))
    many_q, many_c = (F.lit(n).cast("bigint") for n in blocks)
    q = _blocked(queries, "query_id", "qb", many_q, "cb", many_c)
    c = _blocked(corpus, "id", "cb", many_c, "qb", many_q)
    return top_k(_score_blocks(q, c, k, []), k)


def _few_copies(corpus: DataFrame, k: int) -> DataFrame:
    """(id, v) with the k smallest ids of every distinct vector.

    Only vectors whose hash occurs more than k times are compared and ranked;
    the group limit below that shuffle keeps k copies per task.
    """
    rows = corpus.withColumn("hash", F.xxhash64("v"))
    many = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select("hash")
    many = broadcast_if_small(materialise(many, "copied-vectors"))
    copies = Window.partitionBy("hash", "v").orderBy("id")
    ranked = rows.join(many, "hash").withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k)
    return rows.join(many, "hash", "left_anti").select("id", "v").unionByName(ranked.select("id", "v"))


def knn_lsh(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    tables: int = 16,
    width: int = 10,
    corpus_block: int = CORPUS_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Approximate neighbours: exact ranking among rows that share a bucket in any of ``tables`` tables.

    A bucket is the sides of ``width`` planes that a vector lies on. Two vectors at angle a
    share a table's bucket with probability (1 - a / pi) ** width, whatever the size of the corpus;
    more tables find more, wider ones compare less: about a 2 ** -width part of all pairs per table where
    vectors are spread evenly. The defaults find neighbours within 25 degrees with probability 0.98
    and compare 1.6 % of all pairs.

    Equal vectors are searched for and offered once, whatever their number:
    of a corpus vector only the k smallest ids can be hits, and equal queries
    have equal hits. Buckets that are large all the same are cut into blocks.
    """
    queries, corpus = fresh(queries, "query_id"), fresh(corpus, "id")
    first = corpus.select(F.size("v").alias("n")).first()
    buckets = _bucketer(first["n"] if first else 1, tables, width)
    offered = materialise(_few_copies(corpus, k).withColumn("b", buckets("v")), "lsh-corpus")
    asked = queries.groupBy("v").agg(F.min("query_id").alias("query_id"), F.count(F.lit(1)).alias("rows"))
    asked = materialise(asked.withColumn("b", buckets("v")), "lsh-queries")
    key = ["table", "bucket"]

    def hashed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*columns, F.posexplode("b").alias(*key))

    def blocks(df: DataFrame, name: str, size: int) -> DataFrame:
        return hashed(df).groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / size).cast("bigint").alias(name))

    counts = blocks(asked, "nq", query_block).join(blocks(offered, "nc", corpus_block), key)
    counts = broadcast_if_small(materialise(counts, "lsh-blocks"))
    q = hashed(asked, "query_id", "v").join(counts, key)
    c = hashed(offered, "id", "v").join(counts, key)
    q = _blocked(q, "query_id", "qb", F.col("nq"), "cb", F.col("nc")).drop("nq", "nc")
    c = _blocked(c, "id", "cb", F.col("nc"), "qb", F.col("nq")).drop("nq", "nc")
    found = top_k(_score_blocks(q, c, k, key).distinct(), k)
    per_vector = found.groupBy("query_id").agg(F.collect_list(F.struct("id", "score", "rank")).alias("hits"))
    answers = materialise(asked.join(per_vector, "query_id").select("v", "rows", "hits"), "lsh-hits")
    return left_join_unique(queries, answers, "v", "rows").select("query_id", F.inline("hits"))
