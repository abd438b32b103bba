"""The keyed chunk index and its incremental upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import broadcast_if_small, materialise

INSERT, DELETE = "insert", "delete"


def build_index(gold_df: DataFrame) -> DataFrame:
    """chunk_id (unique), chunked_text, path (smallest), n_sources; ``gold_df`` should be a table.

    Rows that repeat a (chunk_id, path) pair are folded in the map tasks, text and all. Pairs are
    then counted apart from the texts: boilerplate shared by a third of all documents is spread by
    path before its one row per path is folded again. A text is shuffled twice at most, to its pair and
    to the row that names its id and path.
    """
    pairs = gold_df.select("chunk_id", "path").distinct()
    ids = pairs.groupBy("chunk_id").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n_sources"))
    folded = gold_df.groupBy("chunk_id", "path").agg(F.first("chunked_text").alias("chunked_text"))
    return folded.join(ids, ["chunk_id", "path"]).select("chunk_id", "chunked_text", "path", "n_sources")


def change_feed(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, chunk_id, change_type between two gold versions.

    An id is a content hash, so an edit is a delete and an insert. Equal to a
    full outer join of the deduplicated keys, but as one aggregate: a single
    shuffle of keys, folded in the map tasks.
    """
    keys = old.select("path", "chunk_id", F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select("path", "chunk_id", F.lit(0).alias("o"), F.lit(1).alias("n"))
    )
    sides = keys.groupBy("path", "chunk_id").agg(F.max("o").alias("o"), F.max("n").alias("n"))
    return sides.where(F.col("o") != F.col("n")).select(
        "path", "chunk_id", F.when(F.col("n") == 1, INSERT).otherwise(DELETE).alias("change_type")
    )


def apply_changes(index: DataFrame | None, new: DataFrame, feed: DataFrame) -> DataFrame:
    """The index of gold version ``new``, from that of the version before and the feed between them.

    Entries whose id the feed does not touch are carried over as they are; only the rows of touched
    ids are read from ``new`` and folded again. While the touched ids are few enough to broadcast,
    no untouched text is shuffled. They travel as 64 bits: an id that shares them with a touched one is folded
    again as well, to what it was. Without an ``index``, before the first version, all ids are touched.
    """
    if index is None:
        return build_index(new)
    bits = F.when(F.col("chunk_id").isNotNull(), F.xxhash64("chunk_id"))
    touched = broadcast_if_small(materialise(feed.select(bits.alias("_bits")).distinct(), "touched"))
    carried = index.withColumn("_bits", bits).join(touched, "_bits", "left_anti").drop("_bits")
    again = new.withColumn("_bits", bits).join(touched, "_bits", "left_semi")
    changed = materialise(again.select("chunk_id", "path", "chunked_text"), "changed")
    return carried.unionByName(build_index(changed).select(carried.columns))
