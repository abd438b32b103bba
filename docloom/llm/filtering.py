"""Dropping rows of a table by decisions that were made on some of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.storage import keep
from docloom.session import broadcast_if_small


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores until it is no column yet."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def stay(docs: DataFrame, decisions: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (_key, kept; one per row of ``docs``) keep, with all their columns.

    Rows of one key are alike in what was judged. If only some of them are kept, one
    of them stays. Text is not shuffled as long as the keys that go are few enough to broadcast.
    """
    some = F.col("kept").cast("int")
    gone = keep(
        decisions.groupBy("_key").agg(F.sum(some).alias("kept"), F.count(F.lit(1)).alias("n")).where("kept < n"), "gone"
    )
    name = fresh("_key", docs.columns)
    named = gone.withColumnRenamed("_key", name)
    keyed = docs.withColumn(name, key)
    left = keyed.join(broadcast_if_small(named.select(name)), name, "left_anti")
    some_stay = named.where("kept > 0").select(name)
    if not some_stay.isEmpty():
        left = left.unionByName(keyed.join(broadcast_if_small(some_stay), name, "left_semi").dropDuplicates([name]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def key_of(*columns: str | Column) -> Column:
    """128 bits of a row's values, each with its length in front and nulls apart: rows of one key are alike in them."""
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts += [F.coalesce(F.length(value).cast("string"), F.lit("-")), F.coalesce(value, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))
