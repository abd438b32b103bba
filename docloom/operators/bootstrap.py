"""Rates of judged runs with their uncertainty, by a Poisson bootstrap in one pass.

A replicate gives every row a weight that follows a Poisson distribution with mean one, made from a
hash of the row's id and the replicate's number. So rows need not be drawn or moved: one grouped aggregate, folded in the map
tasks, sums weights and weighted outcomes of all replicates, and what is shuffled are a few numbers per group
and replicate. The same id has the same weights in every run, so that differences of two runs are paired.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPLICATES = 200
LEVEL = 0.95
#: Larger weights, one in nine million, count as this.
MOST = 9


def poisson_steps(most: int = MOST) -> list[float]:
    """P(weight <= k) for k from 0 on."""
    return [sum(exp(-1) / factorial(j) for j in range(k + 1)) for k in range(most)]


def weight_of(key: Column, replicate: Column) -> Column:
    """The weight of a row in a replicate: the first eight hex digits of md5("key:replicate") as a part of one, by steps."""
    digits = F.substring(F.md5(F.concat_ws(":", key.cast("string"), replicate.cast("string"))), 1, 8)
    part = F.conv(digits, 16, 10).cast("double") / float(1 << 32)
    steps = [F.when(part >= step, 1).otherwise(0) for step in poisson_steps()]
    return sum(steps[1:], steps[0])


def replicated(rows: DataFrame, key: str, values: list[str], group: str | None, replicates: int) -> DataFrame:
    """group, replicate, and for each value the sums w (weights) and s (weighted values) of rows where it is not null.

    Replicate -1 has weight one for every row. The group null holds all rows.
    """
    number = F.explode(F.sequence(F.lit(-1), F.lit(replicates - 1))).alias("replicate")
    chosen = [F.col(group).alias("group")] if group else [F.lit(None).cast("string").alias("group")]
    many = rows.select(F.col(key).alias("_key"), *chosen, *[F.col(v).cast("double").alias(v) for v in values], number)
    weight = F.when(F.col("replicate") < 0, 1).otherwise(weight_of(F.col("_key"), F.col("replicate")))
    weighted = many.withColumn("_w", weight)
    sums = []
    for v in values:
        sums.append(F.sum(F.when(F.col(v).isNotNull(), F.col("_w"))).alias(f"w_{v}"))
        sums.append(F.sum(F.col(v) * F.col("_w")).alias(f"s_{v}"))
    by_group = weighted.groupBy("group", "replicate").agg(*sums)
    if not group:
        return by_group
    # sums of sums: a row per group and replicate
    names = [f"{p}_{v}" for v in values for p in "ws"]
    whole = by_group.groupBy("replicate").agg(*[F.sum(n).alias(n) for n in names])
    return by_group.where(F.col("group").isNotNull()).unionByName(
        whole.withColumn("group", F.lit(None).cast(by_group.schema["group"].dataType))
    )


def intervals(
    rows: DataFrame,
    key: str,
    values: list[str],
    group: str | None = None,
    replicates: int = REPLICATES,
    level: float = LEVEL,
) -> DataFrame:
    """group (null: all), value, rate, low, high: the mean of each value with its percentile interval.

    Null values take no part; a replicate without any does not count. A value that is null in all
    rows of a group has no rate.
    """
    sums = replicated(rows, key, values, group, replicates)
    each = [F.struct(F.lit(v).alias("value"), F.col(f"s_{v}").alias("s"), F.col(f"w_{v}").alias("w")) for v in values]
    long = sums.select("group", "replicate", F.inline(F.array(*each)))
    rate = F.when(F.col("w") > 0, F.col("s") / F.col("w"))
    found = long.groupBy("group", "value").agg(
        F.max(F.when(F.col("replicate") < 0, rate)).alias("rate"),
        F.array_sort(F.collect_list(F.when(F.col("replicate") >= 0, rate))).alias("rates"),
    )

    def at(part: float) -> Column:
        place = F.greatest(F.ceil(F.size("rates") * F.lit(part)), F.lit(1)).cast("int")
        return F.round(F.when(F.size("rates") > 0, F.get("rates", place - 1)), 6)

    tail = round((1 - level) / 2, 9)
    return found.select("group", "value", F.round("rate", 6).alias("rate"), at(tail).alias("low"), at(round(1 - tail, 9)).alias("high"))


def paired(one: DataFrame, two: DataFrame, key: str, values: list[str], **options) -> DataFrame:
    """``intervals`` of the differences ``two`` minus ``one``, row by row of the same id (unique in both)."""
    left = one.select(F.col(key), *[F.col(v).cast("double").alias(f"_{v}") for v in values])
    both = two.join(left, key)
    differences = [(F.col(v).cast("double") - F.col(f"_{v}")).alias(v) for v in values]
    kept = [F.col(options["group"])] if options.get("group") else []
    return intervals(both.select(key, *kept, *differences), key, values, **options)
