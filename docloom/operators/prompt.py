"""Prompt columns, routing rules and label checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.concat import in_order
from docloom.functions.text import fill

# Tone labels, contact numbers and the words that select them.
LABELS = ("Happy", "Unhappy", "Neutral")
MOBILE_NUMBER = "1800-MOBILE"
LANDLINE_NUMBER = "1800-LANDLINE"
MOBILE_WORDS = r"(^|[^a-z])(mobile|handset|cell ?phone|sim|roaming)([^a-z]|$)"
LANDLINE_WORDS = r"(^|[^a-z])(land ?line|home phone|fixed line)([^a-z]|$)"

INSTRUCTION = "{instruction}\n\n{input}\n"
STEPS = "Work through this one step at a time."
ROUTING_INSTRUCTION = f"""You answer requests sent to a telephone company.
- Requests about mobile service: give the mobile number {MOBILE_NUMBER}.
- Requests about a land line: give the land line number {LANDLINE_NUMBER}.
- Anything else: decline kindly.

Keep it short and friendly."""
REQUEST_MARK = "Request:\n"
ROUTING = "{rules}\n\n" + REQUEST_MARK + "{input}"


def plain(text: Column) -> Column:
    """The text as it is."""
    return text


def instruct(instruction: str, text: Column) -> Column:
    return fill(INSTRUCTION, instruction=F.lit(instruction), input=text)


def classify(text: Column, labels: tuple[str, ...] = LABELS, style: str | None = None) -> Column:
    """Ask for one label, optionally with an explanation in a given style."""
    lines = F.array_join(F.transform(F.array(*map(F.lit, labels)), lambda x: F.concat(F.lit("- "), x)), "\n")
    task = fill("What is the tone of this message? Answer with one of:\n{labels}{style}", labels=lines,
                style=F.lit(f"\n{style}" if style else ""))
    return fill(INSTRUCTION, instruction=task, input=text)


def stepwise(question: Column) -> Column:
    return fill("Answer this question.\n\n{question}\n{steps}", question=question, steps=F.lit(STEPS))


def with_context(question: Column, context: Column) -> Column:
    return fill(
        "Answer this question.\n\n{question}\n\nUse this context:\n{context}\n\n{steps}",
        question=question,
        context=context,
        steps=F.lit(STEPS),
    )


def few_shot(df: DataFrame, question: str, examples: DataFrame, n: int, out: str = "prompt") -> DataFrame:
    """Prepend ``n`` worked examples (ord, input, output) to every question.

    The examples are reduced to n rows first and reach the prompts as one
    scalar subquery, so nothing is joined.
    """
    shown = fill("Q: {input}\nA: {output}", input=F.col("input"), output=F.col("output"))
    few = examples.orderBy("ord").limit(n)
    block = few.agg(in_order(F.collect_list(F.struct(F.col("ord").alias("p"), shown.alias("t"))), "\n\n"))
    return df.withColumn(out, fill("{block}\n\nQ: {question}\nA:", block=block.scalar(), question=F.col(question)))


def route_prompt(text: Column) -> Column:
    return fill(ROUTING, rules=F.lit(ROUTING_INSTRUCTION), input=text)


def route(text: Column) -> Column:
    """The routing rules as an expression: MOBILE, LANDLINE or DECLINE."""
    t = F.lower(text)
    return (
        F.when(t.rlike(MOBILE_WORDS), "MOBILE").when(t.rlike(LANDLINE_WORDS), "LANDLINE").otherwise("DECLINE")
    )


def parse_label(output: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The first label named in a model's output, upper-cased; INVALID without one."""
    found = F.upper(F.regexp_extract(output, rf"(?i)\b({'|'.join(labels)})\b", 1))
    return F.when(F.coalesce(found, F.lit("")) == "", "INVALID").otherwise(found)
