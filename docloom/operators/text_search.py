"""Search by query text over stored postings, and retrieval of the matching chunks.

score(q, d) = sum over shared terms of tf_d * w_q / (|tf_d| * |w_q|), with
w_q = tf_q * ln(1 + N / df). Inverse document frequency weighs the query side only,
so a document's length is known from the document alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.concat import in_order
from docloom.operators.postings import Stored, search, store
from docloom.session import broadcast_if_small, materialise

search_text = search


def corpus_of(index: DataFrame, primary_key: str = "chunk_id", text_column: str = "chunked_text") -> DataFrame:
    return index.select(F.col(primary_key).alias("id"), F.col(text_column).alias("text"))


def store_index(index: DataFrame, primary_key: str = "chunk_id", text_column: str = "chunked_text") -> Stored:
    return store(corpus_of(index, primary_key, text_column))


def retrieve(
    queries: DataFrame,
    index: DataFrame,
    stored: Stored,
    k: int = 5,
    primary_key: str = "chunk_id",
    text_column: str = "chunked_text",
    doc_uri: str = "path",
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """query_id, rank, score, chunk_id, chunked_text, path and ``columns`` of the index: hits with text and source.

    Hits are k per query; they are broadcast to the index when their measured
    size allows, so that the index is not shuffled. A query without hits has no row here;
    ``context`` gives it one.
    """
    hits = materialise(search(queries, stored, k), "hits")
    roles = {"id": primary_key, "chunked_text": text_column, "path": doc_uri}
    docs = index.select(*[F.col(c).alias(name) for name, c in roles.items()], *columns)
    return docs.join(broadcast_if_small(hits), "id").select(
        "query_id", "rank", "score", F.col("id").alias("chunk_id"), "chunked_text", "path", *columns
    )


def context(hits: DataFrame, queries: DataFrame | None = None, sep: str = "\n\n") -> DataFrame:
    """query_id, n_docs, context: the texts of a query's hits, best first.

    With ``queries`` every one of them has a row, without hits n_docs 0 and an empty context.
    """
    ranked = F.collect_list(F.struct(F.col("rank").alias("p"), F.col("chunked_text").alias("t")))
    found = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_docs"), in_order(ranked, sep).alias("context"))
    if queries is None:
        return found
    return (
        queries.select("query_id")
        .join(found, "query_id", "left")
        .select(
            "query_id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("context", F.lit("")).alias("context")
        )
    )


def result_arrays(hits: DataFrame, columns: list[str]) -> DataFrame:
    """query_id, data_array: hits as an array of rows, each an array of the chosen columns."""
    row = F.array(*[F.col(c).cast("string") for c in columns])
    rows = F.array_sort(F.collect_list(F.struct("rank", row.alias("cols"))))
    return hits.groupBy("query_id").agg(F.transform(rows, lambda r: r["cols"]).alias("data_array"))


def by_document(hits: DataFrame) -> DataFrame:
    """query_id, path, n_hits, best_rank, chunk_ids: hits that come from the same document together."""
    ids = F.collect_list(F.struct(F.col("rank").alias("p"), F.col("chunk_id").alias("t")))
    return hits.groupBy("query_id", "path").agg(
        F.count(F.lit(1)).alias("n_hits"), F.min("rank").alias("best_rank"), in_order(ids, ",").alias("chunk_ids")
    )


def text_set(hits: DataFrame) -> DataFrame:
    """query_id, found: a query's distinct hit texts as one string."""
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_set("chunked_text")).cast("string").alias("found"))
