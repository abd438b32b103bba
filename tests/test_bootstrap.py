"""Bootstrap intervals against plain Python."""

import hashlib
import random
from math import ceil

import pytest

from docloom.operators import bootstrap


def weight(key, replicate):
    part = int(hashlib.md5(f"{key}:{replicate}".encode()).hexdigest()[:8], 16) / 2**32
    return sum(part >= step for step in bootstrap.poisson_steps())


def brute(rows, replicates=200, level=0.95):
    """(rate, low, high) of (key, value) pairs."""
    rows = [(k, float(v)) for k, v in rows if v is not None]
    if not rows:
        return None, None, None
    rates = []
    for b in range(replicates):
        w = [weight(k, b) for k, _ in rows]
        if sum(w):
            rates.append(sum(x * y for x, (_, y) in zip(w, rows)) / sum(w))
    rates.sort()
    tail = round((1 - level) / 2, 9)
    at = lambda p: round(rates[max(1, ceil(len(rates) * p)) - 1], 6) if rates else None
    return round(sum(v for _, v in rows) / len(rows), 6), at(tail), at(round(1 - tail, 9))


def runs():
    rng = random.Random(1)
    one = [(f"p{i}", rng.choice("ab"), rng.random() < 0.7, None if rng.random() < 0.1 else rng.random() < 0.4, None) for i in range(300)]
    return one, [(k, g, rng.random() < 0.8, y, z) for k, g, _, y, z in one]


SCHEMA = "id string, kind string, x boolean, y boolean, z boolean"


def close(got, expected):
    return all((g is None) == (e is None) and (g is None or abs(g - e) < 2e-6) for g, e in zip(got, expected))


def test_weights_are_poisson():
    counts = [weight(f"k{i}", i % 7) for i in range(20_000)]
    assert abs(sum(counts) / 20_000 - 1) < 0.03 and abs(counts.count(0) / 20_000 - 0.3679) < 0.01
    assert bootstrap.poisson_steps()[-1] > 1 - 2e-6


@pytest.mark.parametrize("group", ["kind", None])
def test_intervals(spark, group):
    one, _ = runs()
    df = spark.createDataFrame(one, SCHEMA).repartition(4)
    got = bootstrap.intervals(df, "id", ["x", "y", "z"], group).collect()
    assert len(got) == (9 if group else 3)
    for r in got:
        own = [q for q in one if r["group"] is None or q[1] == r["group"]]
        expected = brute([(q[0], q["xyz".index(r["value"]) + 2]) for q in own])
        assert close((r["rate"], r["low"], r["high"]), expected), r
    x = next(r for r in got if r["group"] is None and r["value"] == "x")
    assert x["low"] < x["rate"] < x["high"]


def test_paired_differences_are_narrower_than_two_intervals(spark):
    one, two = runs()
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (one, two))
    got = {r["value"]: r for r in bootstrap.paired(a, b, "id", ["x", "y"]).collect()}
    assert close(
        (got["x"]["rate"], got["x"]["low"], got["x"]["high"]),
        brute([(p[0], int(q[2]) - int(p[2])) for p, q in zip(one, two)]),
    )
    assert (got["y"]["rate"], got["y"]["low"], got["y"]["high"]) == (0, 0, 0)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert bootstrap.intervals(df, "id", ["x"], "kind").count() == 0
