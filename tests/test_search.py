import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions.topk import TopK
from docloom.operators import blockmax, postings, text_search, vector


def brute_text(queries, corpus, k):
    def words(t):
        return [w for w in re.split(r"[^a-z0-9]+", t.lower()) if w]

    docs = {i: Counter(words(t)) for i, t in corpus}
    df = Counter(w for c in docs.values() for w in c)
    out = []
    for q, text in queries:
        w = {t: n * math.log(1 + len(docs) / df[t]) for t, n in Counter(words(text)).items() if df[t]}
        size = math.sqrt(sum(x * x for x in w.values()))
        scores = []
        for i, c in docs.items():
            s = sum(c[t] * x / size for t, x in w.items()) / max(1.0, math.sqrt(sum(n * n for n in c.values()))) if w else 0
            if any(c[t] for t in w):
                scores.append((-round(s, 6), i))
        out += [(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    chance = 1 / np.arange(1, 61)
    corpus = [
        (i, " ".join(rng.choice(vocabulary, rng.integers(0, 40), p=chance / chance.sum())) + (" the" if i % 3 else ""))
        for i in range(400)
    ]
    corpus += [(400 + i, corpus[7][1]) for i in range(150)]  # many copies of one text
    queries = [(i, " ".join(rng.choice(vocabulary, 6)) + " the") for i in range(30)] + [(98, "unseen words"), (99, "")]
    return queries, corpus


@pytest.mark.parametrize("limit,shard", [(1 << 26, 10_000), (2_000, 30), (1 << 26, 400)])
def test_text_is_brute_force(spark, texts, limit, shard):
    """Whether queries are taken at once or in batches, and however documents are dealt."""
    queries, corpus = texts
    q = spark.createDataFrame(queries, "query_id int, text string")
    c = spark.createDataFrame(corpus, "id bigint, text string").repartition(6)
    stored = postings.store(c, documents_per_bucket=30, postings_per_folder=700, documents_per_shard=shard)
    assert stored.n == len(corpus) and stored.folders > 1
    got = postings.search(q, stored, 5, limit).select("query_id", "id", "score", "rank").collect()
    want = brute_text(queries, corpus, 5)
    assert [(r[0], r[1], r[3]) for r in sorted(got)] == [(w[0], w[1], w[3]) for w in want]
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(sorted(got), want))


def test_scores_need_no_shuffle(spark, texts):
    """Only top-k hits are exchanged: a document's postings share a bucket."""
    queries, corpus = texts
    stored = postings.store(spark.createDataFrame(corpus, "id bigint, text string"))
    found = postings.search(spark.createDataFrame(queries, "query_id int, text string"), stored, 5)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 1


def test_most_postings_of_common_words_are_passed_over(spark):
    """Documents of a few topics, each with words of its own and words of every text."""
    rng = np.random.default_rng(4)
    common = [f"the{i}" for i in range(5)]
    corpus = []
    for i in range(4_000):
        topic = i % 200
        words = [f"t{topic}w{j}" for j in rng.integers(0, 12, 14)] + list(rng.choice(common, 10))
        corpus.append((i, " ".join(words)))
    queries = [(q, " ".join([f"t{q}w{j}" for j in range(6)] + common)) for q in range(0, 200, 10)]
    stored = postings.store(spark.createDataFrame(corpus, "id bigint, text string"))
    asked = spark.createDataFrame(queries, "query_id int, text string")
    got = sorted((r.query_id, r.rank, r.id) for r in postings.search(asked, stored, 5).collect())
    assert got == [(q, r, i) for q, i, _, r in sorted(brute_text(queries, corpus, 5), key=lambda x: (x[0], x[3]))]
    counted = postings.postings_read(asked, stored).first()
    assert counted["scored"] < 0.4 * counted["postings"]


def test_blocks_hold_every_posting(spark, texts):
    corpus = spark.createDataFrame(texts[1], "id bigint, text string")
    weighted = postings.weighted(corpus)
    shards = blockmax.blocks(weighted, 5).collect()
    ids = {r["shard"]: r["ids"] for r in shards if r["term"] is None}
    assert len(ids) == 5 and sorted(i for own in ids.values() for i in own) == sorted(i for i, _ in texts[1])
    got = set()
    for r in shards:
        if r["term"] is not None:
            assert r["docs"] == sorted(r["docs"]) and r["firsts"][0] == 0
            for first, end, top in zip(r["firsts"], [*r["firsts"][1:], len(r["docs"])], r["tops"]):
                assert len({d // blockmax.RANGE for d in r["docs"][first:end]}) == 1
                assert max(r["weights"][first:end]) == top
            got |= {(ids[r["shard"]][d], r["term"], w) for d, w in zip(r["docs"], r["weights"])}
    assert got == {tuple(r) for r in weighted.select("id", F.inline("pairs")).collect()}


def test_text_ids_may_be_strings(spark):
    q = spark.createDataFrame([("q", "red fox")], "query_id string, text string")
    c = spark.createDataFrame([("b", "red"), ("a", "red"), ("c", "blue"), ("d", None)], "id string, text string")
    got = postings.search(q, postings.store(c), 2).orderBy("rank").collect()
    assert [r.id for r in got] == ["a", "b"]


def test_a_word_of_every_text_is_a_match(spark):
    c = spark.createDataFrame([(i, f"common word{i} " + "filler " * 3000) for i in range(5)], "id int, text string")
    q = spark.createDataFrame([(1, "common")], "query_id int, text string")
    assert postings.search(q, postings.store(c), 3).count() == 3


def test_no_hits(spark):
    q = spark.createDataFrame([(1, "unseen"), (2, "red"), (3, None)], "query_id int, text string")
    index = spark.createDataFrame([("k", "red", "p", 7)], "chunk_id string, chunked_text string, path string, n int")
    stored = text_search.store_index(index)
    hits = text_search.retrieve(q, index, stored, 2, columns=("n",))
    assert [(r.query_id, r.n) for r in hits.collect()] == [(2, 7)]
    got = sorted(tuple(r) for r in text_search.context(hits, q).collect())
    assert got == [(1, 0, ""), (2, 1, "red"), (3, 0, "")]
    empty = postings.store(text_search.corpus_of(index).limit(0))
    assert postings.search(q, empty, 2).count() == 0


def vectors(spark, sf, key):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias(key), F.col("embedding").alias("v"))


def brute_knn(rows, k):
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows], dtype=float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = []
    for i, s in zip(ids, np.round(m @ m.T, 6)):
        order = np.lexsort((ids, -s))[:k]
        out += [(int(i), int(ids[j]), r + 1) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("limit", [1 << 26, 60_000])
def test_knn_is_brute_force(spark, sf, limit):
    corpus = vectors(spark, sf, "id")
    got = vector.knn_exact(vectors(spark, sf, "query_id"), corpus.repartition(5), 4, limit=limit)
    assert sorted(tuple(r) for r in got.select("query_id", "id", "rank").collect()) == brute_knn(corpus.collect(), 4)


def test_knn_with_its_own_rows_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(20, [0.0, 1.0]), (21, [0.0, 0.0]), (22, None)]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(4)
    got = vector.knn_exact(df.where("id in (5, 20)").withColumnRenamed("id", "query_id"), df, 3).collect()
    assert sorted((r.query_id, r.id) for r in got) == [(5, 0), (5, 1), (5, 2), (20, 0), (20, 1), (20, 20)]


def test_top_k_kernel():
    rng = np.random.default_rng(5)
    scores = np.round(rng.normal(size=(40, 3000)), 2)  # many ties
    ids = rng.permutation(3000)
    best = TopK(40, 4)
    for at in range(0, 3000, 170):
        for first in (0, 25):
            block = scores[first : first + 25 if first == 0 else 40]
            best.offer(block[:, at : at + 170], ids[at : at + 170], first)
    for q in range(40):
        order = np.lexsort((ids, -scores[q]))[:4]
        assert best.ids[q].tolist() == ids[order].tolist() and best.score[q].tolist() == scores[q][order].tolist()


def test_vectors_of_different_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id int, v array<float>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        vector.knn_exact(df.withColumnRenamed("id", "query_id"), df, 1).collect()


def test_lsh_recall_and_large_buckets(spark, sf):
    corpus = vectors(spark, sf, "id")
    want = set(brute_knn(corpus.collect(), 3))

    def found(**options):
        got = vector.knn_lsh(vectors(spark, sf, "query_id"), corpus, 3, **options)
        return {tuple(r) for r in got.select("query_id", "id", "rank").collect()}

    # blocks far smaller than the buckets: a large bucket is many groups
    assert found(tables=4, width=2, corpus_block=40, query_block=30) == found(tables=4, width=2)
    assert len(found(tables=16, width=4) & want) / len(want) > 0.8
    # narrow buckets find more with as many tables, and wide ones more with more tables
    few, many = found(tables=4, width=6) & want, found(tables=24, width=6) & want
    assert len(few) < len(many)


def test_lsh_finds_near_neighbours_among_few_pairs(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 64))
    near = base + rng.normal(size=base.shape) * 0.4  # about 22 degrees away
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(4)
    got = vector.knn_lsh(df.where("id < 1500").withColumnRenamed("id", "query_id"), df, 2).collect()
    assert sum(r.id == r.query_id + 1500 for r in got) / 1500 >= 0.9

    n, tables, width = 100_000, 16, 10
    vectors = rng.normal(size=(n, 64))
    sides = vectors @ np.array([vector.direction(b, 64) for b in range(tables * width)]).T > 0
    buckets = sides.reshape(n, tables, width) @ (1 << np.arange(width))
    pairs = sum(int((np.bincount(buckets[:, t]).astype(np.int64) ** 2).sum()) for t in range(tables))
    assert pairs < 0.05 * n * n


def test_lsh_copies(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(300)] + [(300 + i, [0.5, 1.0, i / 50]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, v array<float>").repartition(6)
    got = vector.knn_lsh(df.withColumnRenamed("id", "query_id"), df, 3, query_block=10, corpus_block=10, width=1, tables=6)
    hits = {}
    for r in got.collect():
        hits.setdefault(r.query_id, []).append((r["rank"], r.id))
    assert all(sorted(hits[i]) == [(1, 0), (2, 1), (3, 2)] for i in range(300))
    assert len(hits) == 350


def test_context_and_arrays(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b", "second", "p"), (1, 1, "a", "first", "p"), (1, 3, "c", "first", "q")],
        "query_id int, rank bigint, chunk_id string, chunked_text string, path string",
    )
    assert text_search.context(hits).first().context == "first\n\nsecond\n\nfirst"
    assert text_search.result_arrays(hits, ["chunked_text", "path"]).first().data_array[0] == ["first", "p"]
    assert text_search.text_set(hits).first().found == "[first, second]"
    assert sorted((r.path, r.n_hits, r.best_rank, r.chunk_ids) for r in text_search.by_document(hits).collect()) == [
        ("p", 2, 1, "a,b"),
        ("q", 1, 3, "c"),
    ]


def test_retrieve_with_named_columns(spark):
    index = spark.createDataFrame([("k1", "red fox", "u1"), ("k2", "blue sea", "u2")], "k string, body string, u string")
    q = spark.createDataFrame([(1, "blue")], "query_id int, text string")
    stored = text_search.store_index(index, "k", "body")
    got = text_search.retrieve(q, index, stored, 5, primary_key="k", text_column="body", doc_uri="u").collect()
    assert [(r.chunk_id, r.chunked_text, r.path, r["rank"]) for r in got] == [("k2", "blue sea", "u2", 1)]
