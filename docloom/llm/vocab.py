"""Tokenizer files, read once per Python worker, and ids of whole texts by way of their distinct words."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from docloom.llm.worker import once
from docloom.llm.words import UNUSUAL, Numbers, distinct_words, ragged


def byte_of_char() -> dict[str, int]:
    """The byte that a character in a byte-level vocabulary stands for.

    Printable characters stand for themselves, the other bytes in order for those from U+0100 on.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizer(path: str) -> Tokenizer:
    return once(("tokenizer", path), lambda: Tokenizer.from_file(path))


def _described(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return {k: v for k, v in json.load(f).items() if k != "model"}


def described(path: str) -> dict:
    """A tokenizer file without its vocabulary."""
    return once(("described", path), lambda: _described(path))


def _specials(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    ids = {t["content"]: t["id"] for t in described(path)["added_tokens"]}
    names = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None), ids


def specials(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The strings that stand for one id wherever they occur, and their ids."""
    return once(("specials", path), lambda: _specials(path))


def normalised(path: str, texts: list[str]) -> list[str]:
    """Texts in the form that the tokenizer cuts into words; white space need not be unified."""
    if not described(path)["normalizer"]:
        return texts
    by_library = tokenizer(path).normalizer.normalize_str
    return [by_library(t) if UNUSUAL.search(t) else t.lower() for t in texts]


def segments(path: str, texts: list[str]) -> tuple[list[str], list[int], list[int]]:
    """(strings without special strings, id that follows each or -1, text of each)."""
    pattern, ids = specials(path)
    parts, follows, owner = [], [], []
    for i, text in enumerate(texts):
        found = pattern.split(text) if pattern and "<|" in text else [text]
        for k in range(0, len(found), 2):
            parts.append(found[k])
            follows.append(ids[found[k + 1]] if k + 1 < len(found) else -1)
            owner.append(i)
    return parts, follows, owner


def gathered(
    path: str, texts: list[str], numbers: Numbers, attach_blank: bool
) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, ids before each text): ``numbers`` gives those of a word."""
    parts, follows, owner = segments(path, texts)
    words, place, before, _ = distinct_words(normalised(path, parts), attach_blank)
    start, size, flat = numbers.of(words)
    size_at = size[place]
    out = flat[ragged(start[place], size_at)]
    ends = np.concatenate([[0], np.cumsum(size_at)])[before]
    if len(parts) > len(texts) or any(f >= 0 for f in follows):
        follows = np.asarray(follows)
        marked = np.flatnonzero(follows >= 0)
        out = np.insert(out, ends[1:][marked], follows[marked])
        ends = ends + np.concatenate([[0], np.cumsum(follows >= 0)])
    last = np.searchsorted(np.asarray(owner), np.arange(len(texts)), side="right")
    return out, np.concatenate([[0], ends[last]]) if len(texts) else np.zeros(1, np.int64)


def _byte_ids(path: str):
    """Ids of words by the library's merges alone: a word needs no cutting, and of its tokens only the ids."""

    def make(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        merges, chars = tokenizer(path).model, {b: c for c, b in byte_of_char().items()}
        found = [[t.id for t in merges.tokenize(w.decode("latin-1").translate(chars))] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    return make


def byte_numbers(path: str) -> Numbers:
    return once(("byte numbers", path), lambda: Numbers(_byte_ids(path)))


def byte_encode(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids before each text) by a byte-level BPE file without normalizer, exactly as its library gives them.

    The library cuts a text into words and merges within words only, so
    the ids of distinct words, taken from it once, make up those of texts.
    """
    return gathered(path, texts, byte_numbers(path), attach_blank=True)


def texts_of(column: pa.Array) -> list[str]:
    """Null texts as empty ones."""
    return [t or "" for t in column.to_pylist()]
