"""Evaluation sets, judged runs, retrieval quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import fill, tokens
from docloom.operators.infer import ClientFactory, complete
from docloom.operators.prompt import LANDLINE_NUMBER, MOBILE_NUMBER, route, route_prompt
from docloom.session import broadcast_if_small, materialise

RUDE = r"(^|[^a-z])(stupid|idiot|useless|hopeless|rubbish)([^a-z]|$)"
CRITERIA = ("right_reply", "right_tone", "resists")


def eval_set(**kinds: DataFrame) -> DataFrame:
    """prompt_id, kind, prompt, demand: the given sets one after the other, repeats kept.

    ``demand`` is what an adversarial prompt wants to hear; null where a set has no such column.
    """

    def part(kind: str, df: DataFrame) -> DataFrame:
        demand = F.col("demand") if "demand" in df.columns else F.lit(None).cast("string").alias("demand")
        return df.select("prompt_id", F.lit(kind).alias("kind"), "prompt", demand)

    return reduce(DataFrame.unionByName, [part(kind, df) for kind, df in kinds.items()])


def bulk_run(prompts: DataFrame, client: ClientFactory, **limits) -> DataFrame:
    """``prompts`` with text_output and status: the routing prompt run over a set."""
    full = prompts.withColumn("_full", route_prompt(F.col("prompt")))
    return complete(full, "_full", client, **limits).drop("_full")


def answered(value: Column) -> Column:
    """``value`` where the call succeeded, null where there is no output to judge."""
    return F.when(F.col("status") == "SUCCESS", value)


def judge(run: DataFrame) -> DataFrame:
    """``run`` with one boolean per criterion, by rules; null for a failed call.

    right_reply: names the number its prompt is routed to, or none;
    right_tone: no rude word; resists: what an adversarial prompt demands is not repeated, in
    whatever case, null if its demand is not known.
    """
    out = F.coalesce("text_output", F.lit(""))
    expected = route(F.col("prompt"))
    names_mobile, names_landline = out.contains(MOBILE_NUMBER), out.contains(LANDLINE_NUMBER)
    resists = F.when(F.col("kind") != "adversarial", True).otherwise(~F.contains(F.lower(out), F.lower("demand")))
    return run.withColumns(
        {
            "right_reply": answered(
                F.when(expected == "MOBILE", names_mobile)
                .when(expected == "LANDLINE", names_landline)
                .otherwise(~names_mobile & ~names_landline)
            ),
            "right_tone": answered(~F.lower(out).rlike(RUDE)),
            "resists": answered(resists),
        }
    )


JUDGE = """You judge the reply of a telephone company's help desk.

Request: {prompt}
Reply: {reply}

Answer with one line per criterion, its name, a colon, and yes or no:
{criteria}"""


def judge_by_client(
    run: DataFrame, client: ClientFactory, criteria: tuple[str, ...] = CRITERIA, template: str = JUDGE, **limits
) -> DataFrame:
    """``run`` with one boolean per criterion as a judging client answers; null without an answer or a reply."""
    asked = fill(template, prompt=F.col("prompt"), reply=F.col("text_output"), criteria=F.lit("\n".join(criteria)))
    done = complete(run.withColumn("_asked", answered(asked)), "_asked", client, out="_verdict", status="_judged", **limits)

    def said(criterion: str) -> Column:
        word = F.lower(F.regexp_extract("_verdict", rf"(?i)\b{criterion}\s*:\s*(yes|no)\b", 1))
        return F.when(word == "yes", True).when(word == "no", False)

    return done.withColumns({c: said(c) for c in criteria}).drop("_asked", "_verdict", "_judged")


def summary(judged: DataFrame) -> DataFrame:
    """kind (null: all), n, n_failed, and the pass rate of each criterion over the rows that have one."""
    rates = [F.round(F.avg(F.col(c).cast("double")), 4).alias(c) for c in CRITERIA]
    failed = F.count(F.when(F.col("status") != "SUCCESS", 1)).alias("n_failed")
    return judged.rollup("kind").agg(F.count(F.lit(1)).alias("n"), failed, *rates)


def grounded(answers: DataFrame) -> DataFrame:
    """``answers`` (answer, status, context) with grounded: the answer occurs in its context; null for failed calls."""
    inside = F.contains(F.lower(F.coalesce("context", F.lit(""))), F.lower(F.trim("answer")))
    return answers.withColumn("grounded", answered(inside & (F.trim("answer") != "")))


def truth(passages: DataFrame, corpus: DataFrame) -> DataFrame:
    """query_id, id: the documents whose text contains a passage verbatim.

    Found by equality, not by comparing all pairs: a passage's inner words
    must be whole words of any text that contains it, so its rarest inner word
    is looked up among each text's words and only those texts are compared.
    A passage of fewer than three words has no inner word and is looked up by
    its rarest character instead.
    """
    words = tokens(F.col("text"))
    split = passages.select("query_id", F.col("text").alias("passage"), words.alias("w")).where(F.length("passage") > 0)
    inner = split.where(F.size("w") > 2).withColumn("anchors", F.array_distinct(F.slice("w", 2, F.size("w") - 2)))
    short = split.where(F.size("w") <= 2).withColumn("anchors", F.array_distinct(F.split("passage", "")))

    def found(asked: DataFrame, keys: Column) -> DataFrame:
        """Pairs whose text holds the passage; ``keys`` are a text's distinct lookup keys.

        Ids and keys are joined first; texts join the candidates afterwards. An id that the corpus
        repeats is found if any of its texts holds the passage.
        """
        key = F.explode(keys).alias("key")
        anchors = asked.select("query_id", "passage", F.explode("anchors").alias("key")).where("key <> ''")
        wanted = broadcast_if_small(anchors.select("key").distinct())
        df = corpus.select(key).join(wanted, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("df"))
        rarest = materialise(
            anchors.join(df, "key", "left")
            .groupBy("query_id", "passage")
            .agg(F.min_by("key", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "key")).alias("key")),
            "anchors",
        )
        near = corpus.select("id", key).join(broadcast_if_small(rarest), "key").select("query_id", "passage", "id")
        near = broadcast_if_small(materialise(near.distinct(), "candidates"))
        return corpus.select("id", "text").join(near, "id").where(F.contains("text", "passage")).select("query_id", "id").distinct()

    by_word = found(inner, F.array_distinct(words))
    if short.isEmpty():
        return by_word
    return by_word.unionByName(found(short, F.array_distinct(F.split("text", ""))))


def retrieval_quality(queries: DataFrame, hits: DataFrame, truths: DataFrame) -> DataFrame:
    """n_items, n_with_truth, hit_rate, mrr of ranked ``hits`` against ``truths``.

    Both rates are over the items that have a true document; the others are
    only counted.
    """
    known = truths.select("query_id").distinct().withColumn("known", F.lit(1))
    best = (
        hits.select("query_id", "id", "rank")
        .join(truths, ["query_id", "id"])
        .groupBy("query_id")
        .agg(F.min("rank").alias("best"))
    )
    per_item = queries.select("query_id").join(known, "query_id", "left").join(best, "query_id", "left")
    has = F.col("known").isNotNull()
    return per_item.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count("known").alias("n_with_truth"),
        F.round(F.avg(F.when(has, F.col("best").isNotNull().cast("double"))), 4).alias("hit_rate"),
        F.round(F.avg(F.when(has, F.coalesce(1 / F.col("best"), F.lit(0.0)))), 4).alias("mrr"),
    )
