"""Personal data in texts, also where it is disguised, with places in the source text.

Plain e-mail addresses, IP addresses, card and telephone numbers are found in the text as it is.
Then transducers rewrite what disguises them - look-alike characters, invisible ones,
spelled digits, also among numerals, words for the at sign and the dot - and note for every character of the
result which characters of the source it came from. What the same finders find in the
rewritten text is mapped back. Spans of the plain text all stay.

A transducer's output is searched as a whole, whatever the text's length. Null texts are empty.
Spans count code points, the end excluded. Every row gives a row, repeated ones each; an empty table gives
none. Only the named columns are read, others are kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.endings import ENDINGS
from docloom.llm.worker import once

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The characters of the local part, and the domain.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits without three more parts is taken whole, since no start inside it can succeed either.
IP = re.compile(r"[0-9][0-9]*+((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# Letters of other alphabets and the Latin ones they look like.
LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοıɡ",
        "ABESIJKMHOPCTYXaesijopcyxhdqwABEZHIKMNOPTYXoig",
    )
)
INVISIBLE = "­​‌‍⁠﻿"
HYPHENS = "‐‑‒–—―−"
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")

_DIGIT = "(?:" + "|".join(DIGITS) + ")"
SPELLED = re.compile(rf"(?i)\b(?:plus[\s-]+(?={_DIGIT}\b))?{_DIGIT}(?:[\s-]+{_DIGIT})+\b")
FOLLOWING = re.compile(rf"[\s-]{_DIGIT}\b")
SPELLED_PART = re.compile(rf"(?i)plus[\s-]+|{_DIGIT}|[\s-]+")
# Numerals and digits as words in a row: gaps, dots and the word for the dot are between them.
_ATOM = rf"(?<!\w)(?:[0-9]++|{_DIGIT})(?!\w)"
MIXED = re.compile(rf"(?i)(?:(?<!\w)plus[\s-]++)?{_ATOM}(?:(?:\s++dot\s++|[\s().-]++){_ATOM})+")
MIXED_PART = re.compile(rf"(?i)(plus)[\s-]+|([0-9]+)|({_DIGIT})|(\s+dot\s+)|([\s-]+(?![\s().-]))|[\s().-]+")
LETTER = re.compile(r"[A-Za-z]")
BRACKETED = re.compile(r"(?i)\s?[\[({<]\s?(?:(at|@)|(dot|\.))\s?[\])}>]\s?")
# The at sign or the word for it, a part, and further parts after a dot or the word for it.
WORDED = re.compile(
    r"(?i)(?:(?<!\s)\s*+(@)\s*+|(?<!\s)\s++(at)\s++)([A-Za-z0-9-]++)((?:(?:\.|\s++dot\s++)[A-Za-z0-9-]++(?!\w))+)"
)
WORDED_DOT = re.compile(r"(?i)(?:\.|\s++(dot)\s++)([A-Za-z0-9-]++)")
# All last parts of domains, those that count after any word, and words that others do not follow in prose.
KNOWN = frozenset(ENDINGS.split())
COMMON = frozenset("com org net edu gov mil int info biz name io ai app dev co eu uk us ca au de at ch fr be nl es it pt pl se no dk fi ie jp cn in br mx ru".split())
PROSE = frozenset("a an the this that these those each every any some no my your his her its our their dot".split())
ENDING = re.compile(r"(?i)[a-z]{2,63}|xn--[a-z0-9-]+")
MARKED = re.compile(r"[0-9._]")
AT = re.compile(r"\sat\s+[a-z0-9-]+\.[a-z0-9]")
NAME = re.compile(r"(?i)[a-z][a-z0-9+-]*(?:[._][a-z0-9+-]+)+")


def _plain_forms() -> tuple[dict[str, str], np.ndarray]:
    """Characters that look like ASCII ones, and whether a code point is one: by decomposition, by value, by the list."""
    forms = dict(LOOK_ALIKES) | dict.fromkeys(INVISIBLE, "") | dict.fromkeys(HYPHENS, "-")
    for code in [*range(0x80, 0x3000), *range(0x3000, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000),
                 *range(0x10000, 0x11FFF), *range(0x1D400, 0x1D800), *range(0x1E000, 0x20000)]:
        char = chr(code)
        if char.isdecimal():
            forms.setdefault(char, str(unicodedata.decimal(char)))
        else:
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and "!" <= plain <= "~":
                forms.setdefault(char, plain)
    known = np.zeros(0x110000, bool)
    known[[ord(c) for c in forms]] = True
    return forms, known


def plain_forms() -> tuple[dict[str, str], np.ndarray]:
    return once(("plain forms",), _plain_forms)


def emails(text: str) -> Iterator[Span]:
    """Around each at sign: the run before it from the last match on, and the domain after it."""
    seen, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > seen and text[start - 1] in LOCAL:
            start -= 1
        end = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield "email", start, (end := domain.end())
            seen = end
        at = text.find("@", end)


def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def found_in(text: str) -> list[Span]:
    """The plain identifiers, kind by kind, from left to right."""
    spans = list(emails(text))
    for m in IP.finditer(text):
        # zeros in front do not count, and the library takes no number of thousands of digits
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if m[1] and all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


class Rewritten:
    """A text under rewriting; its character i came from source characters first[i] to last[i], the latter excluded."""

    def __init__(self, text: str):
        self.text = text
        self.first, self.last = np.arange(len(text)), np.arange(1, len(text) + 1)
        self.new = np.zeros(len(text), bool)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put strings in place of ranges, which are in order and apart; every new character came from its whole range."""
        texts, firsts, lasts, news, at = [], [], [], [], 0
        for start, end, put in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:start], put]
            firsts.append(self.first[at:start])
            lasts.append(self.last[at:start])
            news.append(self.new[at:start])
            if put:
                firsts.append(np.full(len(put), self.first[start]))
                lasts.append(np.full(len(put), self.last[end - 1]))
                news.append(np.ones(len(put), bool))
            at = end
        self.text = "".join(texts)
        self.first, self.last, self.new = np.concatenate(firsts), np.concatenate(lasts), np.concatenate(news)


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    forms, known = plain_forms()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return [(i, i + 1, forms[text[i]]) for i in np.flatnonzero(known[points]).tolist()]


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Two or more digits as words in a row, a plus before them too; the gaps between them go."""
    edits = []
    for m in SPELLED.finditer(text):
        for part in SPELLED_PART.finditer(text, *m.span()):
            word = part[0].strip("- \t\r\n").lower()
            put = "+" if word == "plus" else str(DIGITS.index(word)) if word in DIGITS else ""
            edits.append((*part.span(), put))
    return edits


def mixed_digits(text: str) -> list[tuple[int, int, str]]:
    """Digits as words beside numerals or dots, too, and the word for the dot between digits; the gaps beside words go.

    A worded plus counts before a digit as a word or a worded dot, and before a country code and two groups more.
    """
    edits = []
    for m in MIXED.finditer(text):
        if not LETTER.search(m[0]):
            continue
        parts = list(MIXED_PART.finditer(text, *m.span()))
        country = len(parts) > 5 and len(parts[1][0]) <= 3 and not text[max(0, m.start() - 2) : m.start()].strip().isdigit()
        if not country and not any(p[3] or p[4] for p in parts):
            continue
        for i, p in enumerate(parts):
            if p[1]:
                edits.append((*p.span(), "+"))
            elif p[3]:
                edits.append((*p.span(), str(DIGITS.index(p[3].lower()))))
            elif p[4]:
                edits.append((*p.span(), "."))
            elif p[5] and (parts[i - 1][3] or parts[i + 1][3]):
                edits.append((*p.span(), ""))
    return edits


def bracketed(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "@" if m[1] else ".") for m in BRACKETED.finditer(text)]


def worded(text: str, new: np.ndarray | None = None) -> list[tuple[int, int, str]]:
    """``name at host dot com``, also with one of the two in signs: only where both stand, since either alone is prose.

    Characters marked in ``new`` were disguised themselves, so that a dot among them counts as a word. After the word
    "at", plain dots need a name that is none of prose, such as ``jane.doe``.
    """
    edits, seen = [], 0
    for m in WORDED.finditer(text):
        start = m.start()
        while start > seen and text[start - 1] in LOCAL:
            start -= 1
        local, dots = text[start : m.start()], list(WORDED_DOT.finditer(text, *m.span(4)))
        known = KNOWN if m[1] or m[3].lower() not in PROSE else COMMON
        ends = [i for i, d in enumerate(dots, 1) if d[2].lower() in known]
        signs = new is not None and any(new[d.start()] for d in dots)
        # an ending on no list needs an at sign, a dot in signs, two as words, or a name that is no word
        evident = m[1] or signs or (known is KNOWN and (sum(bool(d[1]) for d in dots) > 1 or MARKED.search(local)))
        dots = dots[: ends[-1]] if ends else dots if evident and ENDING.fullmatch(dots[-1][2]) else []
        hidden = any(d[1] or (signs and new[d.start()]) for d in dots)
        if not local or not dots or not (hidden or (m[2] and NAME.fullmatch(local))):
            continue
        first, last = m.start(), m.start(3)
        if m[2] or last - first > 1:
            edits.append((first, last, "@"))
        edits += [(d.start(), d.start(2), ".") for d in dots if d[1]]
        seen = dots[-1].end()
    return edits


def may_spell(lower: str) -> bool:
    """Whether a digit as a word follows a gap, as all but the first in a row do."""
    return any(word in lower for word in DIGITS) and bool(FOLLOWING.search(lower))


def may_word(text: str) -> bool:
    """Whether a word for the dot, or for the at sign, is in ``text``."""
    lower = text.lower()
    return "dot" in lower or bool(AT.search(lower))


def may_mix(lower: str) -> bool:
    return any(word in lower for word in (*DIGITS, "dot", "plus")) and any(LETTER.search(m[0]) for m in MIXED.finditer(lower))


ALIKE = (lambda t: not t.isascii(), look_alikes)
SPELLING = (lambda t: may_spell(t.lower()), spelled_digits)
BRACKETS = (lambda t: any(c in t for c in "[({<"), bracketed)
MIXING = (lambda t: True, mixed_digits)


def rewriting(text: str, done: Rewritten | None, *steps: tuple) -> Rewritten | None:
    """``text``, or the rewriting ``done`` of it, after the steps whose test it passes; None if that is ``text`` itself."""
    done = copy(done)
    for needed, transduce in steps:
        now = done.text if done else text
        if needed(now) and (edits := transduce(now)):
            done = done or Rewritten(text)
            done.replace(edits)
    return done


def disguised(text: str, base: list[Span]) -> list[Span]:
    """What rewritten texts show beyond ``base``, in places of the source.

    Rows of digits as words are rewritten by themselves and, in a second text, together with numerals and dots
    beside them. Both count, since a word beside a number may be none of its digits; addresses that the first
    text shows are complete.
    """
    alike = rewriting(text, None, ALIKE)
    texts = [rewriting(text, alike, SPELLING, BRACKETS)]
    unbracketed = rewriting(text, alike, BRACKETS)
    if may_mix((unbracketed.text if unbracketed else text).lower()):
        texts.append(rewriting(text, unbracketed, MIXING))
    spans = []
    for nth, done in enumerate(texts):
        done = rewriting(text, done, (may_word, lambda t: worded(t, done.new if done else None)))
        if not done:
            continue
        known, whole = [*base, *spans], ("email", "ip") if nth else ()
        # a search that changed characters cannot touch, finds what is known
        for kind, start, end in found_in(done.text):
            first, last = int(done.first[start]), int(done.last[end - 1])
            changed = done.new[start:end].any() or last - first != end - start
            if changed and not any(
                k == kind and (a <= first and last <= b or kind in whole and a < last and first < b) for k, a, b in known
            ):
                spans.append((kind, first, last))
    return spans


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, further disguised ones)."""
    base = found_in(text)
    return base, disguised(text, base)


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("plain", T.BooleanType()),
        ]
    )
)


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans_col``: array of (kind, start, end, plain) by kind, start and end; a column of that name gives way."""

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            base, more = spans_of(text or "")
            marked = [(s, True) for s in base] + [(s, False) for s in more]
            marked.sort(key=lambda x: (KINDS.index(x[0][0]), x[0][1], x[0][2], not x[1]))
            rows.append([{"kind": k, "start": a, "end": b, "plain": plain} for (k, a, b), plain in marked])
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())])
        return pa.array(rows, pa.list_(kind))

    return docs.withColumn(spans_col, spans(F.col(text_col)))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans replaced by the kind of its first span in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all found spans of ``text_col`` replaced by their kind; null stays null."""

    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        done = []
        for text in texts.to_pylist():
            base, more = spans_of(text) if text else ([], [])
            done.append(redacted(text, base + more) if base or more else text)
        return pa.array(done, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col)))
