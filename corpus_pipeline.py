"""A corpus, from documents to packed sequences of token ids.

Every stage gets all that the one before has kept, written as Parquet and read again.
All but the last return the columns of ``documents``.

language     documents of unknown language go
exact_dedup  of equal texts (white space apart) one stays
near_dedup   of documents connected by 5-gram similarity of 0.8 or more one stays
pii          personal data, disguised or not, gives way to its kind in brackets; ``n_chars`` follows
packing      token ids in pieces, placed in sequences of at most 1024
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import exact_dedup, jaccard, language, packing, pii
from docloom.llm.queries import BYTE_BPE, documents
from docloom.llm.storage import keep, text_batches


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return language.keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return jaccard.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset."""
    text_batches(spark)
    return packing.pack(docs, BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Multinomials, signatures and merges are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
