"""Text expressions: namespaces, tokens, templates; the text of markup by ``markup``."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.markup import markup_to_text

__all__ = ["extension", "file_name", "fill", "join_path", "markup_to_text", "namespace", "tokens"]

def namespace(user: Column) -> Column:
    """The part before ``@`` with everything but letters, digits and ``_`` replaced."""
    return F.regexp_replace(F.split_part(user, F.lit("@"), F.lit(1)), r"[^\p{L}\p{N}_]", "_")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def extension(path: Column) -> Column:
    """Lower-case extension of the last path part, '' if it has none."""
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}0-9]+"), "")


def fill(template: str, **values: Column) -> Column:
    """``template`` with its ``{name}`` holes replaced by columns.

    The template is cut at its holes and the pieces concatenated, so braces
    inside a value are never taken for another hole.
    """
    parts: list[Column] = []
    for text, hole, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if hole is not None:
            parts.append(values[hole].cast("string"))
    return F.concat(*parts) if parts else F.lit("")
