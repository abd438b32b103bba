"""Collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from docloom.llm import collocations
from tests.llm.conftest import ROWS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, top=2000):
    count = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    count["und" if lang is None else lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        some = {p: c for p, c in f.items() if len(p) > 1 and c >= support}
        kept = []
        for p, a in some.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in some.items()
            )
            if not inside:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus():
    rng = random.Random(5)
    words = ["New", "york", "big", "BIG", "É", "été", "a", "b", "of", "the", "x y"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rng.randint(0, 25)):
            parts.append(rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "."]))
            if rng.random() < 0.2:
                parts.append("the united states of ")
        rows.append((i, "".join(parts), rng.choice(["en", "en", "fr", None, ""])))
    return rows


@pytest.mark.parametrize("support,shards,words_per_group,bits", [(10, 4, 100, 17), (3, 8, 100_000, 17), (2, 1, 50, 11)])
def test_equals_brute_force(spark, support, shards, words_per_group, bits):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = collocations.collocations(df, support, shards, words_per_group=words_per_group, total_bits=bits)
    assert rows_of(got) == brute([(r[2], r[1]) for r in rows], support)


def test_the_first_of_each_language(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert rows_of(collocations.collocations(df, 10, top=3)) == brute([(r[2], r[1]) for r in rows], 10, 3)


def test_documents(sample):
    rows = [(r["lang"], r["text"]) for r in sample.select("lang", "text").collect()]
    assert rows_of(collocations.collocations(sample)) == brute(rows, 30)


def test_flushed_tasks_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PHRASES_HELD", 500)
    monkeypatch.setattr(collocations, "COUNTED_HELD", 20)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)
    assert rows_of(collocations.collocations(df, 10)) == brute([(r[2], r[1]) for r in rows], 10)


def test_awkward_rows(awkward):
    assert rows_of(collocations.collocations(awkward, support=2)) == brute([(r[2], r[1]) for r in ROWS], 2)
    assert rows_of(collocations.collocations(awkward.limit(0))) == []


def test_one_document_holds_everything(spark):
    df = spark.createDataFrame([(None, "a b " * 40_000, None)], "doc_id bigint, text string, lang string")
    got = rows_of(collocations.collocations(df))
    assert got == brute([(None, "a b " * 40_000)], 30)


def test_numbers_are_stored_in_six_bytes():
    x = np.sort(np.random.default_rng(0).integers(0, 2**64, 100, dtype=np.uint64))
    kept = collocations.cut_short(x)
    assert (collocations.from_six(collocations.to_six(kept)) == kept).all() and (x - kept < 2**16).all()
