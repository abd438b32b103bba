"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import negatives


def brute(rows, positives=5, negatives_=10):
    known = []
    for i, vector, label in rows:
        if i is not None and label is not None and vector is not None:
            if all(x is not None and math.isfinite(x) for x in vector):
                known.append((i, [math.floor(256 * x) for x in vector], label))
    out = []
    for a, row in enumerate(known):
        if row[0] % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(row[1], r[1])), r[0], j, r[2]) for j, r in enumerate(known) if j != a]
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[3] == row[2]][:positives]:
            fits = [s for s in scored if s[3] != row[2] and -30 * p[0] <= -100 * s[0] <= -90 * p[0]]
            out += [(row[0], p[1], k, s[1], -p[0], -s[0]) for k, s in enumerate(fits[:negatives_], 1)]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def mined(spark, rows, kind="array<float>", **options):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, label int")
    return rows_of(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **options))


@pytest.mark.parametrize("limit,size", [(2, 5), (150, 64), (1 << 20, 7), (1 << 27, 64), (0, 3)])
def test_packed_products_are_exact(limit, size):
    rng = np.random.default_rng(limit)
    rows, anchors = rng.integers(-limit, limit + 1, (77, size)), rng.integers(-limit, limit + 1, (9, size))
    bias = int(max(-rows.min(), -anchors.min(), 0))
    most = int(max(rows.max(), anchors.max(), 0)) + bias
    got = negatives.Packed(rows, bias, most).products(anchors)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]


def random_rows(n, seed, size=6, ties=False):
    rng = random.Random(seed)
    steps = 2 if ties else 200
    return [
        (i * 10, [rng.randint(-steps, steps) / (2 * steps) + 0.25 for _ in range(size)], rng.randint(0, 2)) for i in range(n)
    ]


@pytest.mark.parametrize("ties", [False, True])
def test_equals_brute_force(spark, ties):
    rows = random_rows(400, 1, ties=ties)
    expected = brute(rows)
    assert expected
    assert mined(spark, rows) == expected
    assert mined(spark, rows, blocks=(7, 50)) == expected


def test_given_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert rows_of(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)) == brute(rows)


def test_awkward_rows(spark):
    rows = random_rows(40, 2) + [
        (None, [0.5] * 6, 1), (800, None, 1), (900, [0.5] * 6, None), (1000, [0.5, None, 0.5, 0.0, 0.0, 0.0], 1),
        (1100, [float("nan")] + [0.1] * 5, 1), (1200, [float("inf")] * 6, 1), (1300, [], 1), (1400, [0.5, 0.25], 1),
        (100, [0.5] * 6, 1), (100, [0.5] * 6, 1),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and got
    assert mined(spark, rows[-10:-4]) == []
    assert mined(spark, [(100, [0.5], 1)]) == []
    assert mined(spark, []) == []


def test_components_beyond_the_bounds(spark):
    rows = [(0, [1e300, 1.0], 1), (1, [1e300, 0.0], 1), (2, [5e6, 0.0], 2), (3, [-1e300, 0.0], 2)]
    got = mined(spark, rows, "array<double>")
    assert [r[:4] for r in got] == []
    assert all(abs(r[4]) < 2**63 for r in mined(spark, [*rows, (4, [3e6, 0.0], 3)], "array<double>"))


def test_columns_of_other_names_and_clashing_ones(spark):
    rows = [(*r, "x", 7) for r in random_rows(60, 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, _row string, _id int")
    assert rows_of(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)) == brute([r[:3] for r in rows])
