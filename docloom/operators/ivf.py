"""Approximate neighbours by an inverted file: cells around centroids, short codes, exact ranking of a shortlist.

Centroids and the levels of codes are fitted on a bounded sample; every vector is then assigned to its
nearest centroid, and what is left of it is kept as ``BITS`` bits per component. A query looks into the cells whose
centroids are nearest to it and scores their codes; its best ``shortlist`` rows are ranked by their
full vectors. How many cells to look into depends on how much vectors lie in groups; codes cost
an eighth of a vector, and full products are made for the shortlist only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.rank import hit_schema, top_k
from docloom.functions.topk import CELLS, TopK
from docloom.operators.vector import fresh, matrix
from docloom.session import BROADCAST_LIMIT, broadcast_if_small, materialise, measured

#: Rows that centroids and levels are fitted on, at most.
SAMPLE_ROWS = 20_000
ROUNDS = 12
BITS = 2
SHORTLIST = 40
HASHES = 1 << 30


@dataclass(frozen=True)
class Index:
    """(id, cell, code) of every vector; a centroid a row, and the levels of each component that codes stand for."""

    rows: DataFrame
    centroids: np.ndarray
    levels: np.ndarray
    n: int


def centroids_of(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids by k-means on the sphere; the first ones are rows far from those before, of an even choice."""
    rng = np.random.default_rng(0)
    found = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        nearest = (sample @ found.T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        present, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(sample[order], first, axis=0)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found[present] = np.divide(sums, length, out=found[present].copy(), where=length > 0)
    return found


def coded(left: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The nearest level of each component, ``BITS`` bits each, packed into bytes."""
    middle = (levels[1:] + levels[:-1]) / 2
    number = np.zeros(left.shape, np.uint8)
    for step in middle:
        number += left > step
    bits = np.stack([number >> b & 1 for b in range(BITS)], axis=2).reshape(len(left), -1)
    return np.packbits(bits, axis=1)


def decoded(codes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    size = levels.shape[1]
    bits = np.unpackbits(codes, axis=1, count=size * BITS).reshape(len(codes), size, BITS)
    number = (bits << np.arange(BITS, dtype=np.uint8)).sum(axis=2)
    return levels[number, np.arange(size)]


def build(corpus: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> Index:
    """An index of every row of ``corpus`` (id, v) that has a vector; by default as many cells as the root of its rows, 1,024 at most.

    The sample is an even share of the rows by a hash of their ids.
    """
    corpus = fresh(corpus, "id")
    n = corpus.count()
    share = int(min(1.0, sample_rows / max(n, 1)) * HASHES)
    sample = corpus.where(F.pmod(F.xxhash64("id"), F.lit(HASHES)) < share).limit(2 * sample_rows).toArrow()
    vectors = matrix(sample["v"].combine_chunks()) if sample.num_rows else np.zeros((1, 1))
    centroids = centroids_of(vectors, min(len(vectors), cells or min(1_024, max(1, round(n**0.5)))))
    nearest = (vectors @ centroids.T).argmax(axis=1)
    marks = (np.arange(1 << BITS) + 0.5) / (1 << BITS)
    levels = np.quantile(vectors - centroids[nearest], marks, axis=0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = matrix(batch.column("v"))
                cell = (own @ centroids.T).argmax(axis=1)
                codes = coded(own - centroids[cell], levels)
                width = codes.shape[1]
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(codes), [None, pa.py_buffer(codes.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(cell.astype(np.int32)), packed.cast(pa.binary())], names=["id", "cell", "code"]
                )

    kind = corpus.schema["id"].dataType.simpleString()
    rows = corpus.mapInArrow(assign, f"id {kind}, cell int, code binary").repartition("cell").sortWithinPartitions("cell")
    return Index(materialise(rows, "inverted-file"), centroids, levels, n)


def _shortlisted(queries: pa.Table, index: Index, probes: int, shortlist: int, schema) -> DataFrame:
    """query_id, id, score: the rows with the best codes in each task, ``shortlist`` of every query at most."""
    asked = matrix(queries["v"].combine_chunks())
    near = np.zeros((len(asked), len(index.centroids)), bool)
    scores = asked @ index.centroids.T
    np.put_along_axis(near, np.argsort(-scores, axis=1)[:, :probes], True, axis=1)
    name_type = queries.schema.field("query_id").type
    spark = index.rows.sparkSession
    shared = spark.sparkContext.broadcast(
        (np.asarray(queries["query_id"].to_pylist()), asked, near, scores, index.levels)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked, near, scores, levels = shared.value
        best, kind = TopK(len(names), shortlist), None
        width = -(-levels.shape[1] * BITS // 8)
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, ids = batch.column("id").type, np.asarray(batch.column("id").to_pylist())
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, width)
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells):
                own = np.flatnonzero(near[:, cell])
                rows = np.flatnonzero(cells == cell)
                step = max(1, CELLS // max(1, len(own)))
                for at in range(0, len(rows) if len(own) else 0, step):
                    some = rows[at : at + step]
                    found = asked[own] @ decoded(codes[some], levels).T + scores[own, cell][:, None]
                    best.offer_to(own, found, ids[some])
        if kind is not None:
            yield best.batch(names, name_type, kind)

    return index.rows.mapInArrow(search, schema)


def shortlists(queries: DataFrame, index: Index, probes: int, shortlist: int = SHORTLIST, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """query_id, id: the rows whose full vectors a query (query_id, v) is compared with."""
    schema = hit_schema(queries, index.rows)
    batches = measured(queries)[1] // limit + 1
    found = []
    for i in range(batches):
        some = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(batches)) == i) if batches > 1 else queries
        local = some.toArrow()
        if local.num_rows and index.n:
            best = top_k(_shortlisted(local, index, probes, shortlist, schema), shortlist)
            found.append(materialise(best.select("query_id", "id"), "shortlist"))
    if not found:
        return index.rows.sparkSession.createDataFrame([], schema).select("query_id", "id")
    return reduce(DataFrame.unionByName, found)


def knn_ivf(
    queries: DataFrame,
    corpus: DataFrame,
    index: Index,
    k: int = 5,
    probes: int | None = None,
    shortlist: int = SHORTLIST,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """query_id, id, score, rank: nearly the k nearest of ``corpus`` (id, v) per query (query_id, v).

    ``probes`` cells are looked into, by default a quarter of them; vectors that are spread evenly need more.
    Scores are exact. Queries beyond ``limit`` bytes are taken in batches.
    """
    queries = materialise(fresh(queries, "query_id"), "queries")
    probes = probes or -(-len(index.centroids) // 4)
    wanted = shortlists(queries, index, probes, shortlist, limit)
    # both sides are tables: a few ids per query go to the vectors, and those to the queries
    vectors = fresh(corpus, "id").join(broadcast_if_small(wanted), "id").withColumnRenamed("v", "w")
    pairs = vectors.join(broadcast_if_small(queries), "query_id")

    @F.arrow_udf("double")
    def cosine(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array((matrix(left) * matrix(right)).sum(axis=1))

    return top_k(pairs.select("query_id", "id", cosine("v", "w").alias("score")), k)
