"""Texts and labels that must not stop or slow a job."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import bpe, exact_dedup, language, pii, token_counts, vocab, words
from tests.llm.conftest import BYTE_BPE, WORD_BPE


def long_words():
    rng = np.random.default_rng(0)
    letters = "".join(map(chr, rng.integers(97, 123, 300_000)))
    return [letters, "ab" * 150_000, "中文字" * 60_000, "a" * 1_000_000]


@pytest.mark.parametrize("nth", range(4))
def test_a_very_long_word(nth):
    """As the library encodes it, within seconds, by every encoder."""
    word = long_words()[nth]
    by_library = vocab.Tokenizer.from_file(WORD_BPE).encode(word, add_special_tokens=False).ids
    start = time.time()
    ids, before = bpe.word_encode(WORD_BPE, [word, "x"])
    assert ids[: before[1]].tolist() == by_library
    counts, starts = token_counts.prefix_counts(WORD_BPE, [word])
    assert counts[-1] == len(by_library) and starts.tolist() == [0, len(word)]
    ids, before = vocab.byte_encode(BYTE_BPE, [word, "x"])
    assert ids[: before[1]].tolist() == vocab.Tokenizer.from_file(BYTE_BPE).encode(word, add_special_tokens=False).ids
    assert time.time() - start < 60


def test_long_merges_equal_short_ones(monkeypatch):
    rng = np.random.default_rng(1)
    model = bpe.merges(WORD_BPE)
    some = ["".join(map(chr, rng.integers(97, 123, n))).encode() for n in rng.integers(1, 120, 300)]
    short = [model.merge(w) for w in some]
    assert [model.merge_long(w) for w in some] == short


def test_numbers_of_words_in_runs():
    """Whatever is remembered, merged or dropped, a word has its own numbers."""
    made = []

    def make(some):
        made.extend(some)
        sizes = np.array([len(w) % 4 for w in some])
        return np.concatenate([np.full(n, sum(w)) for n, w in zip(sizes, some)] or [np.empty(0)]), sizes

    numbers = words.Numbers(make, most=400)
    rng = np.random.default_rng(2)
    for _ in range(60):
        some = list({f"{'x' * int(n % 7)}{n}".encode() for n in rng.integers(0, 900, 50)})
        start, size, flat = numbers.of(pa.array(some, pa.binary()))
        for i, w in enumerate(some):
            assert flat[start[i] : start[i] + size[i]].tolist() == [sum(w)] * (len(w) % 4)
        assert sum(len(r.hashes) for r in numbers.runs) <= 400
    assert len(numbers.runs) <= 20 and len(made) < 60 * 50
    again = words.Numbers(make)
    again.of(pa.array([b"a", b"b"], pa.binary()))
    n = len(made)
    again.of(pa.array([b"b", b"a"], pa.binary()))
    assert len(made) == n


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(words, "word_hashes", lambda column: np.zeros(len(column), np.uint64))
    numbers = words.Numbers(lambda some: (np.array([len(w) for w in some]), np.ones(len(some), np.int64)))
    for some in ([b"a", b"bb"], [b"bb", b"ccc"], [b"dddd", b"a"]):
        start, size, flat = numbers.of(pa.array(some, pa.binary()))
        assert flat[start].tolist() == [len(w) for w in some]


@pytest.mark.parametrize(
    "text",
    ["1.2.3." + "0" * 5000, "1.2.3." + "0" * 5000 + "4", "10 dot 0 dot 0 dot " + "0" * 5000, "0" * 1_000_000, "one " * 5000],
)
def test_runs_of_zeros(text):
    start = time.time()
    base, more = pii.spans_of(text)
    assert ("ip", 0, len(text)) in base + more or "." not in text and "dot" not in text
    assert time.time() - start < 30


def test_a_column_called_spans_gives_way(spark):
    df = spark.createDataFrame([("jo@example.com", "old", 1)], "text string, spans string, kept int")
    got = pii.find(df)
    assert got.columns == ["text", "spans", "kept"]
    assert [(s["kind"], s["start"]) for s in got.first()["spans"]] == [("email", 0)]


def test_labels_are_languages_by_their_first_part(spark):
    english, german = "the quick brown fox jumps over the lazy dog", "der schnelle braune Fuchs springt über den Hund"
    rows = [(i, english, x, "h") for i, x in enumerate(["en-GB", "EN", "en", "en_US"] * 10)]
    rows += [(100 + i, german, x, "h") for i, x in enumerate(["DE", "de", "de-AT"] * 10)]
    rows += [(200 + i, "12 34 56 ...", x, "h") for i, x in enumerate(["und", "", "mul", "zxx", None, "UND-x"] * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = language.fit(df, "lang")
    assert model.languages == ["de", "en", "und"]
    got = {r["doc_id"]: (r["lang"], r["kept"]) for r in language.of_documents(df).collect()}
    assert {got[i] for i in range(40)} == {("en", True)} and {got[100 + i] for i in range(30)} == {("de", True)}
    assert {got[200 + i] for i in range(18)} == {("und", False)}


@pytest.mark.parametrize("block_bits", [0, 8, 15, 20])
def test_filters_are_as_large_as_what_they_hold(spark, block_bits):
    rng = np.random.default_rng(4)
    prints = np.unique(rng.integers(0, 2**64, 300_000, dtype=np.uint64))
    blocks = prints >> np.uint64(64 - block_bits) if block_bits else np.zeros(len(prints), np.uint64)
    first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
    size, back = 0, []
    for a, b in list(zip(first, [*first[1:], len(prints)]))[:5000]:
        data = exact_dedup.filter_bytes(prints[a:b], np.ones(b - a, np.int64), block_bits)
        size += len(data) - exact_dedup.struct.calcsize(exact_dedup.HEAD)
        back.append(exact_dedup.filter_counts(data)[0])
    held = np.concatenate(back)
    assert (held == prints[: len(held)]).all()
    assert size <= 12 * len(held)


def test_ids_of_equal_texts_may_be_strings_or_the_smallest_number(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "x y")], "doc_id string, text string")
    assert {r["keep_id"] for r in exact_dedup.groups(df).collect()} == {"a"}
    df = spark.createDataFrame([(-(2**63), "x y"), (5, "x y")], "doc_id bigint, text string")
    got = exact_dedup.groups(df).where(F.col("kept")).collect()
    assert [r["doc_id"] for r in got] == [-(2**63)]
