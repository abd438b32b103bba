"""Bronze to silver: text out of binary content, one status per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.concat import ordered_concat
from docloom.functions.markup import read_markup
from docloom.functions.text import extension

Extractor = Callable[[bytes], list[str]]

SUCCESS = "SUCCESS"
MARKUP_EXTENSIONS = ("html", "htm")
STARTS_LIKE_MARKUP = r"(?i)^[ \t\r\n]*<(!doctype html|html)"
SILVER = ["path", "modificationTime", "length", "doc_parsed_contents", "parser_status"]


def parsed(num_pages: Column, text: Column) -> Column:
    return F.create_map(F.lit("num_pages"), num_pages, F.lit("parsed_content"), text)


def _is_markup() -> Column:
    looks = F.col("content").cast("string").rlike(STARTS_LIKE_MARKUP)
    return extension(F.col("path")).isin(*MARKUP_EXTENSIONS) | F.coalesce(looks, F.lit(False))


def _native(bronze: DataFrame) -> DataFrame:
    """Markup by a reader that passes every character once; every other outcome is an error status."""
    ext, content = extension(F.col("path")), F.col("content")
    unknown = F.concat(F.lit("ERROR: no extractor for ."), ext)
    read = F.col("_read")
    status = (
        F.when(~_is_markup() & (ext != ""), unknown)
        .when(content.isNull(), "ERROR: no content")
        .when(F.octet_length("content") == 0, "ERROR: empty content")
        .when(~_is_markup(), unknown)
        .when(read["text"].isNull(), F.concat(F.lit("ERROR: content is not "), read["charset"]))
        .otherwise(SUCCESS)
    )
    ok = F.col("parser_status") == SUCCESS
    done = bronze.withColumn("_read", read_markup(F.when(_is_markup(), content))).withColumn("parser_status", status)
    return done.withColumn(
        "doc_parsed_contents",
        parsed(F.when(ok, "1").otherwise(""), F.when(ok, read["text"]).otherwise("")),
    )


def _supplied(bronze: DataFrame, extractors: dict[str, Extractor]) -> DataFrame:
    """Formats with a user's extractor: bytes to a list of page texts, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pages, texts, states = [], [], []
            for ext, content in zip(pdf["ext"], pdf["content"]):
                try:
                    got = list(extractors[ext](content))
                    one = (str(len(got)), "\n".join(got), SUCCESS)
                except Exception as e:  # a bad file is a row with a status, never a failed job
                    one = ("", "", f"ERROR: {e}")
                pages.append(one[0])
                texts.append(one[1])
                states.append(one[2])
            yield pdf.drop(columns=["ext", "content"]).assign(n=pages, t=texts, parser_status=states)

    schema = "path string, modificationTime timestamp, length bigint, n string, t string, parser_status string"
    out = bronze.select("path", "modificationTime", "length", "content", extension(F.col("path")).alias("ext"))
    return out.mapInPandas(run, schema).withColumn("doc_parsed_contents", parsed(F.col("n"), F.col("t")))


def silver(bronze: DataFrame, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    """path, modificationTime, length, doc_parsed_contents, parser_status.

    A failing row has ``num_pages`` and ``parsed_content`` empty and a status
    that starts with ``ERROR``. The blob never takes part in a shuffle.
    """
    if not extractors:
        return _native(bronze).select(*SILVER)
    mine = extension(F.col("path")).isin(*extractors)
    ours = _native(bronze.where(~mine)).select(*SILVER)
    return ours.unionByName(_supplied(bronze.where(mine), extractors).select(*SILVER))


def page_concat(pages: DataFrame, path: str, page_no: str, text: str) -> DataFrame:
    """path, num_pages, parsed_content from one row per page."""
    return ordered_concat(pages, [path], page_no, text, "\n").select(
        F.col(path).alias("path"), F.col("n").cast("string").alias("num_pages"), F.col("text").alias("parsed_content")
    )


def status_counts(silver_df: DataFrame) -> DataFrame:
    """Documents per outcome: success, or which error."""
    return silver_df.groupBy(F.col("parser_status").alias("status")).agg(F.count(F.lit(1)).alias("n"))
