"""The markup reader against a plain state machine."""

import html
import random
import time

import pytest
from pyspark.sql import functions as F

from docloom.functions import markup
from docloom.operators import extract


def plain(page):
    """Character by character."""
    out, at, n, lower = [], 0, len(page), page.lower()
    while at < n:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            out.append(" ")
            continue
        name = next((x for x in ("script", "style") if lower.startswith("<" + x, at)), None)
        after = page[at + 1 + len(name) : at + 2 + len(name)] if name else ""
        if name and not (after.isascii() and after.isalnum() or after == "-"):
            end = page.find(">", at)
            close = -1 if end < 0 else lower.find("</" + name, end + 1)
            end = -1 if close < 0 else page.find(">", close)
            at = n if end < 0 else end + 1
            out.append(" ")
            continue
        if page[at] == "<" and at + 1 < n and (page[at + 1].isascii() and page[at + 1].isalpha() or page[at + 1] in "/!?"):
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            out.append(" ")
            continue
        out.append(page[at])
        at += 1
    text = "".join(out)
    for c in "\t\r\n":
        text = text.replace(c, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text.strip(" ")


PARTS = ["<", ">", "<!--", "-->", "<script>", "</script>", "<STYLE x>", "</style >", "<b>", "</p>", "<scripty>", "a", " ", "\n",
         "\"", "<3", "-", "x < y", "é", "</", "<!", "script", "<script", "<?", "--"]


def test_equals_a_state_machine():
    rng = random.Random(1)
    for _ in range(20_000):
        page = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))
        assert markup.text_of(page) == plain(page), page


@pytest.mark.parametrize(
    "part", ["<!--", "<script", "<script>", "<style>", "<", "<a ", "</", "&", "&#", "&amp", "<!--x--", "\n", "<script></scrip"]
)
def test_a_megabyte_of_anything_is_read_in_a_moment(part):
    page = part * (1_000_000 // len(part))
    start = time.time()
    markup.text_of("x " + page)
    assert time.time() - start < 3


def test_references():
    got = markup.text_of("&eacute;&Eacute;&#233;&#xE9; &lt;b&gt; &amp;lt; a&nbsp;b&#160;c &hellip; &nosuch; &copy 1 R&D &#0; &;")
    assert got == "éÉéé <b> &lt; a b c … &nosuch; © 1 R&D � &;"
    for name in ("&alpha;", "&NotEqualTilde;", "&frac12;", "&rarr;", "&AMP;"):
        assert markup.text_of(name) == html.unescape(name)


@pytest.mark.parametrize(
    "content,text,charset",
    [
        ("<p>é</p>".encode(), "é", "UTF-8"),
        (b"\xef\xbb\xbf<p>\xc3\xa9</p>", "é", "UTF-8"),
        (b"\xff\xfe" + "<p>é</p>".encode("utf-16-le"), "é", "UTF-16-LE"),
        (b"\xfe\xff" + " <p>é</p>".encode("utf-16-be"), "é", "UTF-16-BE"),
        (b"<meta charset=iso-8859-1><p>\xe9\x80</p>", "é€", "CP1252"),
        (b'<meta http-equiv="x" content="text/html; charset=windows-1251"><p>\xe9', "й", "CP1251"),
        (b'<?xml version="1.0" encoding="Shift_JIS"?><p>\x83A</p>', "ア", "SHIFT_JIS"),
        (b"<meta charset=utf-16><p>a</p>", "a", "UTF-8"),
        (b"<meta charset=nosuch><p>a</p>", "a", "UTF-8"),
        (b"<meta charset=hex><p>a</p>", None, "HEX"),
        (b"\xff\xfe<p>x</p>", None, "UTF-8"),
        (b"<p>\xe9</p>", None, "UTF-8"),
        (b"<meta charset=big5><p>\xff</p>", None, "BIG5"),
    ],
)
def test_character_sets(content, text, charset):
    page, name = markup.decoded(content)
    assert (None if page is None else markup.text_of(page), name) == (text, charset)


def test_pages_of_other_sets_are_extracted(spark):
    rows = [
        ("a.html", None, 1, b"<meta charset=windows-1252><p>\x93caf\xe9\x94 &mdash; 1</p>"),
        ("b.html", None, 1, b"\xff\xfe" + "<html><p>two</p>".encode("utf-16-le")),
        ("c.html", None, 1, b"<meta charset=big5><p>\xff</p>"),
        ("d.html", None, 1, b"<!-- never ends" * 50_000),
    ]
    df = spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint, content binary")
    got = {r.path: (r.parser_status, r.doc_parsed_contents["parsed_content"]) for r in extract.silver(df).collect()}
    assert got == {
        "a.html": ("SUCCESS", "“café” — 1"),
        "b.html": ("SUCCESS", "two"),
        "c.html": ("ERROR: content is not BIG5", ""),
        "d.html": ("SUCCESS", ""),
    }


def test_nulls(spark):
    df = spark.createDataFrame([(None,), ("<p>x",)], "h string")
    assert [r.t for r in df.select(markup.markup_to_text(F.col("h")).alias("t")).collect()] == [None, "x"]
