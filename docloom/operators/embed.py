"""Embeddings of the chunk index as a batch job."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.terms import term_counts
from docloom.functions.text import tokens
from docloom.operators.postings import search_weights, shards_for, store_blocks
from docloom.session import BROADCAST_LIMIT, materialise

SLOTS = T.ArrayType(T.StructType([T.StructField("slot", T.LongType()), T.StructField("weight", T.DoubleType())]))

Embedder = Callable[[list[str]], list[list[float]]]
EmbedderFactory = Callable[[], Embedder]


def embed(index: DataFrame, client: EmbedderFactory, batch: int = 64) -> DataFrame:
    """``index`` with an embedding column; one client per task, ``batch`` texts per call.

    The index has one row per distinct chunk, so each text is embedded once;
    the result is written out, so later actions do not call the model again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = client()
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                yield part.assign(embedding=list(model(part["chunked_text"].tolist())))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return materialise(index.mapInPandas(run, f"{fields}, embedding array<float>"), "embedded")


def slots_of(words: pa.Array, slots: int) -> np.ndarray:
    """The slot of each word: the first eight hex digits of its md5, folded."""
    return np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % slots for w in words.to_pylist()], np.int64)


def slot_counts(lists: pa.ListArray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, count) of every slot that a row's words fall into, in row order."""
    row, word, count, _, words = term_counts(lists)
    key = row * slots + slots_of(words, slots)[word]
    key, place = np.unique(key, return_inverse=True)
    return key // slots, key % slots, np.bincount(place, count, len(key)).astype(np.int64)


def fit(texts: DataFrame, slots: int) -> tuple[DataFrame, int]:
    """(slot, df) and the number of texts: all that an embedding needs to know of its corpus, one row per slot at most."""

    @F.arrow_udf("array<bigint>")
    def held(lists: pa.Array) -> pa.Array:
        row, slot, _ = slot_counts(lists, slots)
        ends = np.searchsorted(row, np.arange(len(lists) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot))

    words = tokens(F.coalesce("text", F.lit("")))
    df = texts.select(F.explode(held(words)).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    return materialise(df, "slot-counts"), texts.count()


def postings_of(model: tuple[DataFrame, int]) -> int:
    """How many slots the texts of ``model`` hold, all told."""
    return model[0].agg(F.sum("df")).first()[0] or 0


def embed_hashed(texts: DataFrame, model: tuple[DataFrame, int], slots: int, nested: bool = False) -> DataFrame:
    """id, slot, weight: hashed TF-IDF at unit length, sparse, without a model server, text by text without a shuffle.

    ``slots`` is to be well above the vocabulary, so that different words rarely meet; slots that the
    corpus does not hold are left out. Texts and questions share one model. What is sent to the tasks are
    eight bytes a slot, and ``slots`` must keep them within the limit of a broadcast. ``nested``: id and pairs, an array
    of (slot, weight), a row per text.
    """
    df, n = model
    if 8 * slots > BROADCAST_LIMIT:
        raise ValueError(f"{slots} slots take more than {BROADCAST_LIMIT} bytes")
    local = df.toArrow()
    weights = np.zeros(slots)
    weights[local["slot"].to_numpy()] = np.log(1 + n / local["df"].to_numpy())
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf(SLOTS)
    def weighted(lists: pa.Array) -> pa.Array:
        row, slot, count = slot_counts(lists, slots)
        weight = count * shared.value[slot]
        row, slot, weight = row[weight > 0], slot[weight > 0], weight[weight > 0]
        length = np.sqrt(np.bincount(row, weight * weight, len(lists)))
        pairs = pa.StructArray.from_arrays([pa.array(slot), pa.array(weight / length[row])], ["slot", "weight"])
        ends = np.searchsorted(row, np.arange(len(lists) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    pairs = weighted(tokens(F.coalesce("text", F.lit(""))))
    return texts.select("id", pairs.alias("pairs") if nested else F.inline(pairs))


def search_sparse(queries: DataFrame, corpus: DataFrame, k: int = 5, size: tuple[int, int] | None = None) -> DataFrame:
    """query_id, id, score, rank: the nearest of ``corpus`` (id, slot, weight) per query (query_id, slot, weight).

    By block-max postings of the slots, as texts are searched; weights are positive. A corpus with nested pairs (id, pairs)
    has unique ids and need not be gathered; where ``size``, its rows and pairs, is known, it is read once.
    """
    documents = corpus
    if "pairs" not in corpus.columns:
        pair = F.struct(F.col("slot").alias("term"), F.col("weight").cast("double").alias("weight"))
        documents = corpus.groupBy("id").agg(F.collect_list(pair).alias("pairs"))
    if size is None:
        documents = materialise(documents, "sparse-documents")
        facts = documents.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("pairs")).alias("size")).first()
        size = facts["n"], facts["size"] or 0
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    blocks = store_blocks(documents, shards_for(*size, cores))
    asked = queries.select("query_id", F.col("slot").cast("string").alias("term"), F.col("weight").alias("w"))
    return search_weights(asked, blocks, k)
