"""Exact and near duplicates against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from docloom.llm import components, exact_dedup, filtering, jaccard, shingles
from tests.llm.conftest import EXTRA, ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    for bits in (0, 3):
        prints = rng.integers(0, 2**64, 500, dtype=np.uint64)
        if bits:
            prints = prints >> np.uint64(bits) | np.uint64(5 << 61)
        counts = rng.integers(1, 2**34, 500)
        order = np.argsort(prints)
        kept, n = exact_dedup.counted(prints, counts)
        assert kept.tolist() == prints[order].tolist()
        back, m = exact_dedup.counted(*exact_dedup.filter_counts(exact_dedup.filter_bytes(kept, n, bits)))
        assert (back == kept).all() and (m == n).all()


def test_repeated_fingerprints(spark):
    rows = [(i,) for i in range(-500, 500)] + [(7,)] * 900 + [(-3,)] * 2
    df = spark.createDataFrame(rows, "fp bigint").repartition(5)
    expected = {(7, 901), (-3, 3)}
    for n in (10, 1 << 20):
        assert {(r["fp"], r["n"]) for r in exact_dedup.repeated(df, n).collect()} == expected


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups(sample, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[squeezed(t)].append(i)
    got = exact_dedup.groups(sample).collect()
    assert len(got) == len(texts)
    for r in got:
        own = groups[squeezed(texts[r["doc_id"]])]
        best = min(own, key=lambda i: (-len(texts[i]), i))
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best, len(own), r["doc_id"] == best)


def test_exact_awkward_rows(awkward):
    got = exact_dedup.groups(awkward).collect()
    assert len(got) == len(ROWS)
    fox = [r for r in got if r["group_size"] == 3]
    assert len(fox) == 3 and {r["keep_id"] for r in fox} == {2} and sum(r["kept"] for r in fox) == 1
    empty = [r for r in got if r["group_size"] == 4]
    assert {r["keep_id"] for r in empty} == {4} and sum(r["kept"] for r in empty) == 1
    left = exact_dedup.keep_one(awkward)
    assert left.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 2, 4, 6, 7, 8]
    assert exact_dedup.groups(awkward.limit(0)).count() == 0


def test_a_tie_goes_to_the_smallest_id(spark):
    df = spark.createDataFrame([(None, "a b"), (5, "b a"), (5, "a b"), (5, "a b"), (3, "ab")], "doc_id bigint, text string")
    got = exact_dedup.groups(df).collect()
    ab = [r for r in got if r["group_size"] == 4]
    assert {r["keep_id"] for r in ab} == {5}
    assert [(r["doc_id"], r["kept"]) for r in ab].count((5, True)) == 1


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(300)]
    links += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components.components(df).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components.components(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.9999):
        bands, rows = jaccard.bands_for(0.8, recall)
        assert bands * rows <= jaccard.MOST_HASHES
        assert 1 - (1 - 0.8**rows) ** bands >= recall
    with pytest.raises(ValueError):
        jaccard.bands_for(0.05, 0.9999)


def gram_set(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def test_shingles_are_sets_of_words():
    given = ["a b c d e f", "a b c d e", "a\tb  c d e ", "a b", "", "  ", "é b c d e f a b c d e f", "ab c d e f", "a bc d e f"]
    found = {}
    for a, b, numbers, before in shingles.sets(given):
        for i in range(a, b):
            found[i] = frozenset(numbers[before[i - a] : before[i - a + 1]].tolist())
    for i, x in enumerate(given):
        for j, y in enumerate(given):
            assert len(found[i] & found[j]) == len(gram_set(x) & gram_set(y))
            assert len(found[i]) == len(gram_set(x))


def brute_force(docs):
    sets = [gram_set(t) for _, t in docs]
    links = [[] for _ in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i].append(j)
                links[j].append(i)
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    out = {}
    for i, (doc, _) in enumerate(docs):
        members = [docs[j][0] for j in range(len(docs)) if label[j] == label[i]]
        out[doc] = min(members), len(links[i]), len({sets[j] for j in links[i]} - {sets[i]})
    return out


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def test_join_equals_brute_force(spark):
    rng = random.Random(3)
    rows = near_copies(150, 4)
    rows += [(1000 + i, " ".join(f"y{rng.randint(0, 50)}" for _ in range(rng.randint(0, 40)))) for i in range(100)]
    rows += [(2000 + i, "one two three") for i in range(5)] + [(3000, ""), (3001, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    expected = brute_force(rows)
    for block in (16, 128):
        got = jaccard.classes(df, block=block).collect()
        assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_linked_texts"]) for r in got} == expected
        assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted({c for c, _, _ in expected.values()})


def test_join_on_documents(sample, texts):
    expected = brute_force(sorted(texts.items()))
    got = jaccard.classes(sample).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_linked_texts"]) for r in got} == expected


def test_groups_are_bounded(spark):
    """One bucket of many texts is dealt into blocks, and no pair is lost or met twice."""
    df = spark.createDataFrame([(bytes([i]), 100, 1, [7, i]) for i in range(100)],
                               "_set binary, _n bigint, weight bigint, _bands array<bigint>")
    met = jaccard.members(df, 8).toPandas()
    groups = met.groupby(["bucket", "one", "two"])
    assert groups.size().max() <= 8 * 2 * 3
    pairs = defaultdict(int)
    for (_, one, two), g in groups:
        rows = list(zip(g["_set"].map(bytes), g["block"]))
        for x, a in rows:
            for y, b in rows:
                if x < y and {a, b} == {one, two}:
                    pairs[x, y] += 1
    assert len(pairs) == 100 * 99 // 2 and set(pairs.values()) == {1}


def test_join_awkward_rows(awkward):
    got = jaccard.classes(awkward).collect()
    assert len(got) == len(ROWS)
    assert {(r["class_id"], r["n_links"]) for r in got if r["doc_id"] in (1, 2)} == {(1, 2)}
    assert all(r["n_links"] == 0 and r["kept"] for r in got if r["doc_id"] in (3, 4, 5))
    left = jaccard.keep_one(awkward)
    assert left.columns == awkward.columns
    assert left.count() == len(ROWS) - 2
    assert jaccard.classes(awkward.limit(0)).count() == 0


def test_stay_keeps_clashing_columns(awkward, spark):
    decisions = awkward.select(filtering.key_of("doc_id", "text").alias("_key")).selectExpr("_key", "true AS kept")
    assert filtering.stay(awkward, decisions, filtering.key_of("doc_id", "text")).count() == len(ROWS)
    assert set(EXTRA) <= set(awkward.columns)
