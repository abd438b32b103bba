"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence meet in a sum of logarithms per language:

* the text, as a multinomial over hashed letter triples, tempered because triples overlap;
* the language that the markup declares, P(declared | language) counted over all documents;
* the suffix of the address, P(suffix | language) counted and smoothed likewise;
* the host's prior, smoothed towards its domain's, which is smoothed towards that of all documents.

All counts are grouped aggregations of what the text alone says, in whole thousandths of a
document so that sums do not depend on their order; a document's own share is taken out of its
host's. Every label that names one is a language; only the multinomials are fitted on a bounded sample of labelled rows. The language ``und``
has a uniform multinomial and wins where no known language explains a text.

A document is kept if its text has a letter and the known languages together reach a probability of
``least``; doubt between two of them is no reason to drop it. Null and empty texts have no letter. Missing
evidence (null declaration, suffix, host) is neutral. Every row gives a row; only the named columns are read.
An empty table, or one without labels, gives no languages but ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import vocab
from docloom.llm.filtering import key_of, stay
from docloom.llm.storage import keep
from docloom.llm.words import NUMBER, OTHER, classes, code_points, slices
from docloom.session import broadcast_if_small

#: Labelled rows that the multinomials are fitted on, at most; but up to ``LABEL_ROWS`` of every label.
TRAIN_ROWS = 20_000
LABEL_ROWS = 100
BITS = 14
SMOOTH = 0.5
TEXT_WEIGHT = 0.1
#: Documents that a parent's distribution counts for.
STRENGTH = 5.0
LEAST = 0.5
UNKNOWN = "und"
# Tags of no certain, several, and no linguistic content.
NO_LANGUAGE = (UNKNOWN, "mul", "zxx")
#: What a text weighs as evidence of no known language before it is read.
UNKNOWN_WEIGHT = 0.01
HASHES = 1 << 30


@dataclass
class Model:
    languages: list[str]
    #: ln P(triple | language), a row per language and ``und`` last; a last column of zeros.
    weights: np.ndarray


def triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every letter triple, where each text's begin); texts are lower-cased, a blank on either side.

    Triples of anything but letters and white space are no evidence: numbers, addresses and
    symbols belong to no language. They share the last bucket.
    """
    points, starts = code_points([f" {t.lower()} " for t in texts])
    wide = points.astype(np.uint32)
    key = wide * np.uint32(0x9E3779B1)
    key[:-1] += wide[1:] * np.uint32(0x85EBCA77)
    key[:-2] += wide[2:] * np.uint32(0xC2B2AE3D)
    key ^= key >> np.uint32(15)
    bucket = ((key * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)).astype(np.int32)
    kind = classes()[points]
    other = (kind == OTHER) | (kind == NUMBER)
    other[:-1] |= other[1:]
    other[:-1] |= other[1:]
    bucket[other] = 1 << BITS
    ends = starts[1:]
    bucket[ends - 1] = bucket[ends - 2] = 1 << BITS
    return bucket, starts


def rows_per_label(counts: list[int], rows: int, least: int = LABEL_ROWS) -> float:
    """How many rows of each label make ``rows`` together, where rarer labels give all they have; ``least`` or more."""
    left, at_most = rows, float(max([least, *counts]))
    for nth, n in enumerate(sorted(counts)):
        at_most = left / (len(counts) - nth)
        if n > at_most:
            return max(at_most, least)
        left -= n
    return float(max([least, *counts]))


def fit(
    docs: DataFrame, label_col: str, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Multinomials of all labels, in a sample of about ``rows`` labelled rows.

    A label counts by its first part, as a declaration does; empty ones and those that name no language are none.
    Labels are counted over all rows, and each gives an even share of its own, by a hash of the id: rare ones all rows.
    """
    labelled = docs.select(
        F.col(id_col).alias("id"), first_part(F.col(label_col)).alias("label"), F.col(text_col).alias("text")
    ).where(~F.col("label").isin("", *NO_LANGUAGE) & F.col("text").isNotNull())
    counts_of = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    languages, most = sorted(counts_of), rows_per_label(list(counts_of.values()), rows)
    shares = docs.sparkSession.createDataFrame(
        [(x, i, int(min(1.0, most / counts_of[x]) * HASHES)) for i, x in enumerate(languages)],
        "label string, language int, below bigint",
    )
    sample = (
        labelled.join(F.broadcast(shares), "label")
        .where(F.pmod(F.xxhash64("id"), F.lit(HASHES)) < F.col("below"))
        .select("language", "text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), (1 << BITS) + 1), np.int64)
        for batch in batches:
            labels = batch.column(0).to_numpy()
            texts = vocab.texts_of(batch.column(1))
            for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
                bucket, starts = triples(texts[a:b])
                owner = np.repeat(labels[a:b], np.diff(starts))
                for x in np.unique(owner):
                    counts[x] += np.bincount(bucket[owner == x], minlength=(1 << BITS) + 1)
        language, bucket = np.nonzero(counts[:, :-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(language), pa.array(bucket), pa.array(counts[language, bucket])], names=["language", "bucket", "n"]
        )

    counts = np.zeros((len(languages) + 1, 1 << BITS))
    if languages:
        found = sample.mapInArrow(count, "language bigint, bucket bigint, n bigint")
        sums = found.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[sums["language"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    counts += SMOOTH
    weights = np.log(counts / counts.sum(axis=1, keepdims=True))
    return Model([*languages, UNKNOWN], np.append(weights, np.zeros((len(weights), 1)), axis=1))


def likelihoods(model: Model, texts: list[str]) -> np.ndarray:
    """ln P(text | language), tempered: a row per text."""
    out = np.zeros((len(texts), len(model.languages)))
    for a, b in slices(np.fromiter(map(len, texts), np.int64, len(texts))):
        bucket, starts = triples(texts[a:b])
        for i, weights in enumerate(model.weights):
            out[a:b, i] = np.add.reduceat(weights[bucket], starts[:-1])
    out *= TEXT_WEIGHT
    out[:, -1] += np.log(UNKNOWN_WEIGHT)
    return np.round(out, 6)


def _zip(values: Column, parent: Column, n: Column) -> Column:
    """A distribution from counts (thousandths of ``n`` documents) smoothed towards ``parent``; that itself for null."""
    smoothed = F.zip_with(values, parent, lambda c, p: (c / 1000.0 + STRENGTH * p) / (n + STRENGTH))
    return F.coalesce(smoothed, parent)


def _literal(values) -> Column:
    """Numbers as one constant, however many they are."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    parts = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(parts, lambda p: p / total)


def first_part(tag: Column) -> Column:
    """``en`` of ``en-GB`` or ``EN_gb``."""
    return F.lower(F.split_part(F.regexp_replace(tag, "_", "-"), F.lit("-"), F.lit(1)))


def identify(
    docs: DataFrame,
    model: Model,
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    domain: Column | None = None,
    least: float = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, lang, probability, text_lang, kept and _key, a hash of the id and all evidence, for every row.

    The columns of evidence are expressions over ``docs``. A declaration counts by its
    first part, ``en-GB`` as ``en``.
    """
    none = F.lit(None).cast("string")
    languages, kinds = model.languages, range(len(model.languages))
    names = F.array(*map(F.lit, languages))

    @F.arrow_udf(T.ArrayType(T.DoubleType(), False))
    def text_evidence(texts: pa.Array) -> pa.Array:
        rows = likelihoods(model, vocab.texts_of(texts))
        ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))

    said = first_part(declared if declared is not None else none)
    known = F.when(said.isNull() | (said == ""), None).otherwise(
        # the place among the languages, or one beyond them
        F.coalesce(F.nullif(F.array_position(names, said), F.lit(0)) - 1, F.lit(len(languages)))
    )
    evidence = [(c if c is not None else none).alias(n) for n, c in (("_suffix", suffix), ("_host", host), ("_domain", domain))]
    text = F.col(text_col)
    rows = (
        docs.select(
            F.col(id_col).alias("_id"),
            known.cast("int").alias("_declared"),
            *evidence,
            F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
            key_of(id_col, text, said, *[c for c in (suffix, host, domain) if c is not None]).alias("_key"),
            text_evidence(text).alias("_text"),
        )
        .withColumn("_share", F.transform(_softmax(F.col("_text")), lambda p: F.round(1000 * p).cast("bigint")))
    )
    rows = keep(rows, "language-evidence")
    sums = [F.sum(F.col("_share")[i]).alias(f"s{i}") for i in kinds]
    shares = F.array(*[F.col(f"s{i}") for i in kinds])
    n = F.count(F.lit(1)).alias("n")

    # The counts of all documents and per declaration: as many numbers as languages, squared at most.
    by_declared = {r["_declared"]: r for r in rows.groupBy("_declared").agg(n, *sums).collect()}
    totals = np.array([sum(r[f"s{i}"] for r in by_declared.values()) for i in kinds]) / 1000.0
    everything = _literal((totals + STRENGTH / len(languages)) / (totals.sum() + STRENGTH))
    matrix = np.zeros((len(languages) + 1, len(languages)))
    with_declaration = np.zeros(len(languages))
    for d, r in by_declared.items():
        if d is not None:
            matrix[d] = np.array([r[f"s{i}"] for i in kinds]) / 1000.0
            with_declaration += matrix[d]
    spoken = (matrix + SMOOTH) / (with_declaration + SMOOTH * (len(languages) + 1))
    neutral = _literal(np.zeros(len(languages)))
    row = F.slice(_literal(np.log(spoken).ravel()), F.col("_declared") * len(languages) + 1, len(languages))
    declared_score = F.coalesce(row, neutral)

    suffixes = rows.where(F.col("_suffix").isNotNull()).groupBy("_suffix").agg(n, *sums)
    with_suffix = suffixes.agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in kinds]).first()
    of = _literal([(with_suffix[f"s{i}"] or 0) / 1000.0 for i in kinds])
    expected = F.col("n") / F.lit(float(with_suffix["n"] or 1))
    suffix_scores = keep(
        suffixes.select(
            "_suffix",
            F.zip_with(
                shares, of, lambda c, total: F.log((c / 1000.0 + STRENGTH * expected) / ((total + STRENGTH) * expected))
            ).alias("_suffix_score"),
        ),
        "suffix-evidence",
    )
    hosts = rows.where(F.col("_host").isNotNull()).groupBy("_host", "_domain").agg(n, *sums)
    domains = hosts.where(F.col("_domain").isNotNull()).groupBy("_domain").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in kinds]
    )
    domain_priors = domains.select("_domain", _zip(shares, everything, F.col("n")).alias("_parent"))
    host_counts = keep(
        hosts.select("_host", "_domain", F.col("n").alias("_n"), shares.alias("_counts"))
        .join(broadcast_if_small(keep(domain_priors, "domain-priors")), "_domain", "left")
        .select(F.col("_host").alias("_of"), F.col("_domain").alias("_in"), "_n", "_counts", "_parent"),
        "host-priors",
    )
    of_host = (F.col("_host") == F.col("_of")) & (F.coalesce("_domain", F.lit("")) == F.coalesce("_in", F.lit("")))
    joined = rows.join(broadcast_if_small(host_counts), of_host, "left").join(
        broadcast_if_small(suffix_scores), "_suffix", "left"
    )
    others = F.zip_with("_counts", "_share", lambda c, own: c - own)
    prior = _zip(others, F.coalesce("_parent", everything), F.col("_n") - 1)
    parts = F.arrays_zip(
        F.col("_text").alias("t"),
        declared_score.alias("d"),
        F.coalesce("_suffix_score", neutral).alias("s"),
        prior.alias("p"),
    )
    scores = F.transform(parts, lambda x: x["t"] + x["d"] + x["s"] + F.log(x["p"]))

    def best(values: Column) -> Column:
        return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    unknown = F.get("_posterior", F.lit(len(languages) - 1))
    known_ones = F.slice("_posterior", 1, max(1, len(languages) - 1))
    kept = F.col("_letters") & (1 - unknown >= least) & F.lit(len(languages) > 1)
    return (
        joined.withColumn("_posterior", _softmax(scores))
        .withColumn("kept", kept)
        .select(
            F.col("_id").alias(id_col),
            F.when(F.col("kept"), best(known_ones)).otherwise(UNKNOWN).alias("lang"),
            F.round(F.when(F.col("kept"), F.array_max(known_ones)).otherwise(unknown), 6).alias("probability"),
            best(F.col("_text")).alias("text_lang"),
            "kept",
            "_key",
        )
    )


def of_documents(docs: DataFrame, **options) -> DataFrame:
    """``identify`` for rows with a declared language ``lang`` and a ``source`` as host, fitted on their declarations."""
    return identify(docs, fit(docs, "lang"), F.col("lang"), host=F.col("source"), **options)


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source) whose language is known, unchanged."""
    key = key_of("doc_id", "text", first_part(F.col("lang")), "source")
    return stay(docs, of_documents(docs), key)
