"""Text of markup pages, read in one pass, and their character sets.

From left to right, whatever comes first: a comment ends with ``-->``; ``script`` and ``style`` elements
end with their closing tag; a tag begins with ``<`` and a letter, ``/``, ``!`` or ``?`` and ends with ``>``. What
does not end reaches to the end of the page, so that every character is passed once; it
leaves a blank. White space is then made single blanks, and character references are resolved, all of those the
standard names and all numeric ones, each once. A no-break space becomes a blank. Any other ``<`` or ``&`` is text.
"""

from __future__ import annotations

import codecs
import html
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMOVED = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)(?![A-Za-z0-9-])[^>]*(?:>.*?(?:</\1[^>]*(?:>|\Z)|\Z)|\Z)|<[A-Za-z/!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
WHITE = re.compile(r"[ \t\r\n]+")
REFERENCE = re.compile(r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{0,31};?)")
#: Where a page may declare its character set: what browsers look at.
HEAD = 1024
DECLARED = re.compile(rb"<meta[^>]*?charset\s*=\s*[\"']?\s*([A-Za-z0-9_:.-]+)|<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9_:.-]+)", re.I)
# Byte order marks, and labels that mean another set than they name.
MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
MEANT = {"iso8859-1": "cp1252", "ascii": "cp1252", "utf-16": "utf-8", "utf-16-le": "utf-8", "utf-16-be": "utf-8"}

READ = T.StructType([T.StructField("text", T.StringType()), T.StructField("charset", T.StringType())])


def _resolved(found: re.Match) -> str:
    char = html.unescape(found[0])
    return char.replace("\xa0", " ") if char != found[0] else char


def text_of(page: str) -> str:
    """The text of a markup page."""
    text = WHITE.sub(" ", REMOVED.sub(" ", page)).strip(" ")
    return REFERENCE.sub(_resolved, text) if "&" in text else text


def charset_of(content: bytes) -> tuple[str, int]:
    """(name of the character set, bytes of its mark): by mark, then by declaration, else UTF-8.

    A mark of two bytes counts only where markup follows it in that set: two stray bytes do not make a page unreadable.
    """
    for mark, name in MARKS:
        if content.startswith(mark):
            if len(mark) > 2 or content[2:64].decode(name, "replace").lstrip()[:1] == "<":
                return name, len(mark)
    if found := DECLARED.search(content[:HEAD]):
        try:
            name = codecs.lookup((found[1] or found[2]).decode("ascii")).name
            return MEANT.get(name, name), 0
        except LookupError:
            pass
    return "utf-8", 0


def decoded(content: bytes) -> tuple[str | None, str]:
    """(the page as a string, null if its bytes do not fit; the name of its character set in upper case)."""
    name, skip = charset_of(content)
    try:
        page = codecs.decode(content[skip:], name, "strict")
        return (page if isinstance(page, str) else None), name.upper()
    except (UnicodeError, ValueError, TypeError):
        return None, name.upper()


@F.arrow_udf(T.StringType())
def markup_to_text(pages: pa.Array) -> pa.Array:
    """The text of pages that are strings; null stays null."""
    return pa.array([None if p is None else text_of(p) for p in pages.to_pylist()], pa.string())


@F.arrow_udf(READ)
def read_markup(contents: pa.Array) -> pa.Array:
    """The text and the character set of pages that are bytes; the text is null where the bytes do not fit the set."""
    texts, names = [], []
    for content in contents.to_pylist():
        page, name = (None, None) if content is None else decoded(content)
        texts.append(None if page is None else text_of(page))
        names.append(name)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(names, pa.string())], ["text", "charset"])
