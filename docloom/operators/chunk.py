"""Silver to gold: overlapping chunks with content-hash ids."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 1000
OVERLAP = 150
SEPARATORS = ("\n\n", "\n", " ")


def _cut(window: str, size: int, overlap: int) -> int:
    """Where to end a full window: after its last separator that lies past the overlap."""
    for sep in SEPARATORS:
        end = window.rfind(sep) + len(sep)
        if end - len(sep) >= 0 and end > overlap:
            return end
    return size


def split_boundary(text: str | None, size: int, overlap: int) -> list[str]:
    """Chunks of at most ``size`` characters that end at a separator where one is near.

    The next chunk starts at the first word that begins within the last
    ``overlap`` characters of the one before.
    """
    out: list[str] = []
    start, n = 0, len(text or "")
    while start < n:
        if n - start <= size:
            out.append(text[start:])
            break
        end = start + _cut(text[start : start + size], size, overlap)
        out.append(text[start:end])
        tail = text[end - overlap : end]
        gaps = [i for i in (tail.find(" "), tail.find("\n")) if i >= 0]
        start = end - overlap + (min(gaps) + 1 if gaps else 0)
    return [c for c in (piece.strip(" \n") for piece in out) if c]


def boundary_chunks(size: int = SIZE, overlap: int = OVERLAP) -> Callable[[Column], Column]:
    """An Arrow function text -> array of chunks with its parameters bound."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_boundary(t, size, overlap))

    return split


def fixed_chunks(size: int = SIZE, overlap: int = OVERLAP) -> Callable[[Column], Column]:
    """An expression text -> array of windows of ``size`` that start every ``size - overlap``.

    The text is cut once into steps and each window is put together from
    neighbouring steps, which stays linear in the length of the text.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    span = -(-size // step)

    def split(text: Column) -> Column:
        n = F.length(text)
        steps = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
        count = F.greatest(F.lit(1), F.ceil((n - overlap) / step)).cast("int")
        places = F.sequence(F.lit(1), count)
        # the outer transform binds the steps, which would be cut anew for each window otherwise
        windows = F.transform(
            F.array(steps),
            lambda s: F.transform(
                places, lambda i: F.left(F.array_join(F.slice(s, i, F.lit(span)), ""), F.lit(size))
            ),
        )
        return F.when(n > 0, F.flatten(windows))

    return split


def gold(silver_df: DataFrame, splitter: Callable[[Column], Column] | None = None) -> DataFrame:
    """path, chunked_text, chunk_id, chunk_pos: one row per chunk.

    A document without text has no chunk and so no row here; see
    ``dropped_docs``.
    """
    splitter = splitter or boundary_chunks()
    # exploding the expression, not a column that holds it: for a column the optimizer would add a
    # "not empty" filter and so split every text a second time
    chunks = F.posexplode(splitter(F.col("doc_parsed_contents.parsed_content")))
    return silver_df.select("path", chunks.alias("chunk_pos", "chunked_text")).select(
        "path", "chunked_text", F.md5("chunked_text").alias("chunk_id"), "chunk_pos"
    )


def chunk_stats(gold_df: DataFrame) -> DataFrame:
    n = F.length("chunked_text").cast("bigint")
    return gold_df.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min(n).alias("min_chars"),
        F.round(F.avg(n), 4).alias("avg_chars"),
        F.max(n).alias("max_chars"),
    )


def dropped_docs(silver_df: DataFrame, gold_df: DataFrame) -> DataFrame:
    """Documents that produced no chunk, with the reason the parser gave.

    Gold is reduced to its distinct paths before the shuffle, so a document
    with very many chunks weighs as much as any other.
    """
    return silver_df.select("path", "parser_status").join(gold_df.select("path").distinct(), "path", "left_anti")
