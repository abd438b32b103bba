"""Connected components of a table of links, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.storage import keep
from docloom.session import broadcast_if_small


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def components(links: DataFrame) -> DataFrame:
    """node, label: for every node of ``links`` (a, b) but the smallest of its component, that smallest one.

    Every round links each node's neighbours to the smallest among them, first the larger
    neighbours, then the smaller ones, until all that is left are stars; a chain takes about
    as many rounds as its length has bits. Minima are folded before they are
    shuffled, and links meet minima in joins whose large keys can be split. Null nodes are not allowed.
    """
    a, b = F.col("a"), F.col("b")
    stars = keep(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    state = _state(stars)
    while state[0]:
        both = stars.unionByName(stars.select(b.alias("a"), a.alias("b")))
        least = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least-neighbours")
        large = keep(
            both.join(broadcast_if_small(least), "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct(),
            "large-stars",
        )
        least = keep(large.groupBy("a").agg(F.min("b").alias("m")), "least-neighbours")
        rest = large.join(broadcast_if_small(least), "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        stars = keep(rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(a.alias("node"), b.alias("label"))
