"""Quality rules: a hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and pairs of neighbouring words fall into hash buckets. Two multinomials over
the buckets are counted: one over all texts, one over the trusted ones, both smoothed by
one count per bucket. A text's score is the mean of ln(trusted / raw) over its n-grams,
in whole thousandths so that sums do not depend on their order, and it is
kept at ``threshold`` or above. Everything here is DataFrame expressions.

Null texts have no words, fail the base rules and are not kept. Without trusted rows both
multinomials are smooth or raw alike and the threshold decides by that. Repeated rows each count
and each give a row; an empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.storage import keep
from docloom.session import broadcast_if_small

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
BUCKETS = 10_007
PAIR = 1_000_003
#: Thousandths of a nat per n-gram.
THRESHOLD = -80
HASHES = 1 << 30


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def with_hashes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with _words, and _hash, a number per word."""
    return docs.withColumn("_words", words(F.col(text_col))).withColumn(
        "_hash", F.transform("_words", lambda w: F.crc32(w.cast("binary")))
    )


def buckets(buckets: int = BUCKETS) -> Column:
    """The bucket of every word and of every pair of neighbours, from _hash."""
    single = F.transform("_hash", lambda h: F.pmod(h, F.lit(buckets)))
    second = F.slice("_hash", 2, F.greatest(F.size("_hash") - 1, F.lit(0)))
    first = F.slice("_hash", 1, F.greatest(F.size("_hash") - 1, F.lit(0)))
    return F.concat(single, F.zip_with(first, second, lambda a, b: F.pmod(a * PAIR + b, F.lit(buckets))))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", most: int | None = None) -> DataFrame:
    """The different ids in ``labels``; given ``most``, an even share of about so many by hash where there are more."""
    ids = labels.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    if most is None:
        return ids
    share = min(1.0, most / max(1, ids.count()))
    return ids.where(F.pmod(F.xxhash64(id_col), F.lit(HASHES)) < int(share * HASHES))


def weights(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_buckets: int = BUCKETS,
) -> list[int]:
    """Thousandths of ln(trusted / raw) per bucket: as many numbers as buckets, whatever the corpus.

    ``trusted`` has distinct ids, as ``trusted_ids`` gives them; they are broadcast only if they are few.
    """
    good = keep(trusted.select(F.col(id_col).alias("_id"), F.lit(1).alias("_trusted")), "trusted-ids")
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        broadcast_if_small(good), "_id", "left"
    )
    counts = (
        with_hashes(marked, "_text")
        .select("_trusted", F.explode(buckets(n_buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted"))
    )
    found = counts.collect()
    raw = n_buckets + sum(r["raw"] for r in found)
    trusted_sum = n_buckets + sum(r["trusted"] for r in found)
    by = {r["bucket"]: (r["raw"] + 1, r["trusted"] + 1) for r in found}
    ratios = (by.get(b, (1, 1)) for b in range(n_buckets))
    return [round(1000 * math.log(t * raw / (r * trusted_sum))) for r, t in ratios]


def repeat_words() -> Column:
    """From _repeats, sorted (hash, window, place): words in windows that occur twice or more."""
    r = F.col("_repeats")
    last = F.size(r) - 1

    def again(x: Column, i: Column) -> Column:
        before = (i > 0) & (F.get(r, i - 1)["window"] == x["window"])
        return before | ((i < last) & (F.get(r, i + 1)["window"] == x["window"]))

    places = F.array_sort(F.transform(F.filter(r, again), lambda x: x["place"]))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("at"))

    def covered(total: Column, place: Column) -> Column:
        more = F.least(F.lit(WINDOW), place - total["at"])
        return F.struct((total["n"] + more).alias("n"), place.alias("at"))

    return F.coalesce(F.aggregate(places, zero, covered, lambda x: x["n"]), F.lit(0).cast("bigint"))


def with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``with_hashes`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Windows are compared by hash; only in texts where hashes repeat, the
    windows' words themselves are sorted and compared.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    many = F.greatest(F.size("_hash") - (WINDOW - 1), F.lit(0))

    def at(column: str, i: Column) -> list[Column]:
        return [F.get(F.col(column), i + k) for k in range(WINDOW)]

    windows = F.transform(F.slice("_hash", 1, many), lambda _, i: F.xxhash64(*at("_hash", i)))
    spelled = F.transform(
        "_windows",
        lambda h, i: F.struct(
            h.alias("hash"), F.concat_ws(" ", *at("_words", i)).alias("window"), i.alias("place")
        ),
    )
    repeating = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return (
        with_hashes(docs, text_col)
        .withColumn("_lines", lines)
        .withColumn("_windows", windows)
        .withColumn("_repeats", F.when(repeating, F.array_sort(spelled)))
        .withColumns(
            {
                "n_words": F.size("_words").cast("bigint"),
                "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
                "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
                "n_repeat_words": repeat_words(),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


def rated(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: int = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_buckets: int = BUCKETS,
) -> DataFrame:
    """id, the base columns, n_grams, score (thousandths, summed over n-grams), kept."""
    table = F.split(F.lit(",".join(map(str, weights(docs, trusted, id_col, text_col, n_buckets)))), ",").cast("array<int>")
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    based = with_base(own, "_text").withColumn("_buckets", buckets(n_buckets))
    zero = F.lit(0).cast("bigint")
    score = F.aggregate("_buckets", zero, lambda total, b: total + F.get(table, b.cast("int")))
    return based.withColumn("n_grams", F.size("_buckets").cast("bigint")).withColumn("score", score).select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_grams",
        "score",
        (~F.col("base_failed") & (F.col("score") >= threshold * F.col("n_grams"))).alias("kept"),
    )
