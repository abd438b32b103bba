"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import (
    bpe,
    collocations,
    exact_dedup,
    jaccard,
    language,
    negatives,
    packing,
    pii,
    quality,
    repeats,
    token_counts,
    token_file,
    warc,
)
from docloom.functions.text import markup_to_text
from docloom.llm.storage import text_batches
from docloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


@query
def op1_language_id(spark, sf):
    """Documents: their declared language, and their source as host."""
    return language.of_documents(documents(spark, sf)).drop("_key")


@query
def language_id_pages(spark, sf):
    """Pages: the language their markup declares, the suffix of their address, their host and its domain."""
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))
    pages = spread(table(spark, sf, "pages"), "page_id").select(
        F.col("page_id").alias("doc_id"),
        markup_to_text(F.col("html")).alias("text"),
        F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
    )
    model = language.fit(documents(spark, sf), "lang")
    found = language.identify(
        pages,
        model,
        F.col("declared"),
        F.nullif(F.regexp_extract("host", r"\.([a-z]+)$", 1), F.lit("")),
        F.col("host"),
        F.nullif(F.regexp_extract("host", r"([^.]+\.[a-z]+)$", 1), F.lit("")),
    )
    return found.withColumnRenamed("doc_id", "page_id").drop("_key")


@query
def op2_quality_rules(spark, sf):
    """Documents labelled good are the trusted text."""
    trusted = quality.trusted_ids(table(spark, sf, "labels").where("quality = 1"))
    return quality.rated(documents(spark, sf), trusted)


@query
def op3_bpe_round_trip(spark, sf):
    done = bpe.decode(bpe.encode(documents(spark, sf), WORD_BPE), WORD_BPE)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_warc_salvage(spark, sf):
    archives = warc.write(spread(table(spark, sf, "pages"), "page_id"))
    return warc.pages_of(warc.read(archives)).drop("payload")


@query
def op5_best_fit_packing(spark, sf):
    made = packing.keep(packing.pieces(documents(spark, sf), BYTE_BPE), "pieces")
    digests = made.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op6_token_counts(spark, sf):
    return token_counts.token_counts(documents(spark, sf), WORD_BPE)


@query
def op7_ngram_jaccard(spark, sf):
    return jaccard.classes(documents(spark, sf)).drop("_key")


@query
def op8_token_file(spark, sf):
    read = token_file.read(token_file.write(documents(spark, sf), BYTE_BPE))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op9_pii_spans(spark, sf):
    found = pii.find(documents(spark, sf).select("doc_id", "text"))
    plain = F.filter("spans", lambda s: s["plain"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    digest = F.sha2(pii.joined(plain), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.joined(F.col("spans")).alias("spans"))


@query
def op10_exact_dedup(spark, sf):
    return exact_dedup.groups(documents(spark, sf)).drop("_key")


@query
def op11_substring_dedup(spark, sf):
    left = repeats.without_repeats(documents(spark, sf))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_collocations(spark, sf):
    return collocations.collocations(documents(spark, sf))


@query
def op13_hard_negatives(spark, sf):
    """Every vector whose id is divisible by 100 is an anchor; labels of ids divisible by 7 are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spread(table(spark, sf, "embeddings"), "vec_id").withColumn("label", moved)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
