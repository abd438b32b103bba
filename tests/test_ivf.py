"""Neighbours by cells and codes against exact ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions.topk import TopK
from docloom.operators import ivf, vector
from docloom.plans import queries as q


def frame(spark, rows, key="id"):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(rows)], f"{key} bigint, v array<double>")


def hits(df):
    return {(r["query_id"], r["id"]) for r in df.collect()}


def grouped(n, groups=30, size=16, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, size))
    return middle[rng.integers(0, groups, n)] + 0.25 * rng.normal(size=(n, size))


def test_codes_stand_for_the_nearest_level():
    rng = np.random.default_rng(0)
    left = rng.normal(size=(50, 13))
    levels = np.quantile(left, [0.125, 0.375, 0.625, 0.875], axis=0)
    got = ivf.decoded(ivf.coded(left, levels), levels)
    assert ivf.coded(left, levels).shape == (50, 4)
    nearest = np.abs(left[:, None, :] - levels[None]).argmin(axis=1)
    assert np.allclose(got, levels[nearest, np.arange(13)])


def test_every_row_is_in_the_index(spark):
    df = frame(spark, grouped(700)).unionByName(spark.createDataFrame([(9999, None)], "id bigint, v array<double>"))
    index = ivf.build(df, sample_rows=100)
    assert index.n == 700 and len(index.centroids) == 26
    assert sorted(r["id"] for r in index.rows.collect()) == list(range(700))


def test_groups_need_few_cells_and_few_vectors(spark):
    corpus = frame(spark, grouped(3000))
    queries = corpus.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    index = ivf.build(corpus, 30)
    exact = hits(vector.knn_exact(queries, corpus, 3))
    found = ivf.knn_ivf(queries, corpus, index, 3, probes=3, shortlist=60)
    assert len(hits(found) & exact) >= 0.9 * len(exact)
    compared = ivf.shortlists(queries, index, 3, 60).count()
    assert compared <= 0.02 * 60 * 3000
    scores = {(r["query_id"], r["id"]): r["score"] for r in vector.knn_exact(queries, corpus, 20).collect()}
    assert all(abs(r["score"] - scores.get((r["query_id"], r["id"]), r["score"])) < 1e-6 for r in found.collect())


def test_batches_of_queries_find_the_same(spark):
    corpus = frame(spark, grouped(600))
    queries = corpus.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    index = ivf.build(corpus, 10)
    whole = hits(ivf.knn_ivf(queries, corpus, index, 3))
    assert hits(ivf.knn_ivf(queries, corpus, index, 3, limit=1500)) == whole


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01", "sf0.1"])
def test_given_vectors(spark, name):
    """At the registered parameters."""
    row = q.QUERIES["knn_ivf_recall"](spark, f"/root/testdata/{name}").first()
    assert row["recall"] >= 0.9 and row["pairs_compared"] < 0.1 and row["exact_hits"] % 3 == 0


def test_string_ids_copies_and_no_rows(spark):
    rows = [(f"k{i:03d}", [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "id string, v array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.1]), ("none", None)], "query_id string, v array<double>")
    got = ivf.knn_ivf(asked, df, ivf.build(df, 2), 3, 2).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["k001", "k003", "k005"]
    empty = df.limit(0)
    assert ivf.knn_ivf(asked, empty, ivf.build(empty), 3).count() == 0
    assert ivf.knn_ivf(asked.where("query_id = 'none'"), df, ivf.build(df, 2), 3).count() == 0


def test_hits_may_be_offered_to_any_queries():
    best = TopK(4, 2)
    best.offer_to(np.array([3, 1]), np.array([[0.1, 0.5, 0.4], [0.9, 0.2, 0.3]]), np.array([7, 8, 9]))
    best.offer_to(np.array([1]), np.array([[0.95]]), np.array([4]))
    assert best.ids[3].tolist() == [8, 9] and best.ids[1].tolist() == [4, 7]
    assert np.isneginf(best.score[[0, 2]]).all()


def test_exact_search_goes_block_by_block(spark, sf):
    found = q.QUERIES["knn_exact_each"](spark, sf)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
    corpus = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    at_once = vector.knn_exact(corpus.where("id % 50 = 0").withColumnRenamed("id", "query_id"), corpus, 3)
    assert hits(found) == hits(at_once)
