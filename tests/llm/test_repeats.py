"""Substring dedup against brute force."""

import random
import re

import numpy as np
import pytest

from docloom.llm import byte_words, membership, repeats
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(words, removed places) of each (id, text)."""
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            least = first.get(tuple(words[at : at + window]))
            if least is not None and (i is None or least < i):
                gone |= set(range(at, at + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window", [2, 3, 5, 8, 13, 39, 40, 50, 77])
def test_covers_hold_every_distance(window):
    period, cover = repeats.cover_for(window)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert 1 <= window - period + 1 <= window and set(cover) <= set(range(period))


def test_run_numbers():
    x = np.random.default_rng(0).integers(0, 2**64, 40, dtype=np.uint64)
    for width in (1, 2, 3, 20, 31):
        got = byte_words.run_numbers(x, width)
        for i in range(len(x) - width + 1):
            total = 0
            for n in x[i : i + width]:
                total = (total * int(byte_words._TIMES) + int(n)) % 2**64
            assert int(got[i]) == total


def test_words_are_cut_at_six_characters():
    texts = ["a b\tc\x0bd\x1ce", "", " \n", " x yé"]
    words = byte_words.cut(*byte_words.joined(texts))
    assert [s.decode() for s in words.strings().to_pylist()] == [w for t in texts for w in WORD.findall(t)]
    assert np.diff(words.before).tolist() == [len(WORD.findall(t)) for t in texts]
    assert len(set(words.numbers().tolist())) == len(set(words.strings().to_pylist()))
    assert not set(words.numbers().tolist()) & set(words.numbers(1).tolist())


def test_filter_misses_nothing(spark):
    rng = np.random.default_rng(3)
    inside, outside = rng.integers(-(2**63), 2**63, (2, 3000))
    bits = membership.filter_of(spark.createDataFrame([(int(x),) for x in inside], "n bigint"), 17)
    assert len(bits) == 1 << 14
    assert membership.may_hold(bits, inside.view(np.uint64), 17).all()
    assert membership.may_hold(bits, outside.view(np.uint64), 17).mean() < 0.1
    none = membership.filter_of(spark.createDataFrame([], "n bigint"), 17)
    assert not membership.may_hold(none, inside.view(np.uint64), 17).any()


def corpus(seed):
    """Few different words, so that matches begin anywhere, overlap and repeat within a text."""
    rng = random.Random(seed)
    passages = [[rng.choice("abcdef") for _ in range(rng.randint(6, 30))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"w{rng.randint(0, 999)}"] * rng.randint(1, 7)
        rows.append((rng.choice([i, i, i // 2, None]), rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("window,bits", [(7, 17), (12, 9), (50, 17)])
def test_equals_brute_force(spark, window, bits):
    """With few bits anchors are joined, otherwise looked up."""
    rows = corpus(window)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = repeats.without_repeats(df, window=window, total_bits=bits)
    assert result(got) == brute(rows, window)


def test_documents(sample, texts):
    assert result(repeats.without_repeats(sample)) == brute(texts.items(), 50)


def test_spans_are_what_goes(spark):
    text = " ".join(f"x{i}" for i in range(60))
    df = spark.createDataFrame([(2, "before " + text), (1, text + " after"), (3, "no")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in repeats.without_repeats(df).collect()}
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 61)] and got[2]["kept"] == "before"
    assert got[1]["spans"] == [] and got[3]["kept"] == "no"


def test_awkward_rows(awkward):
    got = result(repeats.without_repeats(awkward))
    assert got == brute([r[:2] for r in ROWS], 50)
    assert repeats.without_repeats(awkward.limit(0)).count() == 0


def test_string_ids(spark):
    text = " ".join(f"x{i}" for i in range(60))
    df = spark.createDataFrame([("b", text), ("a", text)], "doc_id string, text string")
    assert {(r["doc_id"], r["n_removed"]) for r in repeats.without_repeats(df).collect()} == {("a", 0), ("b", 60)}


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 5000}" for i in range(300_000))
    df = spark.createDataFrame([(1, text), (2, "x " + text)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.without_repeats(df).collect()}
    assert got == {1: (300_000, 0), 2: (300_001, 300_000)}
