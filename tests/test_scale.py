"""Searches and indexes whose cost must not outgrow their input."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.operators import blockmax, embed, index, postings, vector
from docloom.plans import queries as q
from docloom.plans import tables as t


class Weights:
    def __init__(self, rows):
        self.table = pa.table(dict(zip(("query_id", "term", "w"), map(list, zip(*rows)))))

    def select(self, *_):
        return self

    def toArrow(self):
        return self.table


@pytest.fixture(scope="module")
def shard(spark):
    """Texts and questions of a few everyday words each: hardly anything can be passed over."""
    rng = np.random.default_rng(8)
    words, chance = [f"w{i}" for i in range(80)], 1 / np.arange(1, 81)
    corpus = [(i, " ".join(rng.choice(words, 30, p=chance / chance.sum()))) for i in range(700)]
    weighted = postings.weighted(spark.createDataFrame(corpus, "id bigint, text string"))
    table = blockmax.blocks(weighted, 1).toArrow()
    asked = [
        (qid, w, float(x))
        for qid in range(blockmax.MANY + 40)
        for w, x in zip(rng.choice([*words, "unseen"], 12, replace=False), rng.random(12))
    ]
    vectors = {r["id"]: {p["term"]: p["weight"] for p in r["pairs"]} for r in weighted.collect()}
    return blockmax.Shard(table, blockmax.RANGE), asked, vectors


def brute(asked, vectors, k):
    ids = sorted(vectors)
    by_query = {}
    for qid, term, w in asked:
        by_query.setdefault(qid, []).append((term, w))
    out = []
    for qid, terms in sorted(by_query.items()):
        scores = sorted((-round(sum(vectors[i].get(x, 0) * w for x, w in terms), 6), i) for i in ids)
        out += [(qid, i) for s, i in scores[:k] if s < 0]
    return out


def hits(best, names):
    return [(names[at], int(i)) for at in np.argsort(names) for i, s in zip(best.ids[at], best.score[at]) if s > -np.inf]


def test_many_everyday_questions_are_scored_in_whole(shard):
    """a few questions tell that ranges exclude little; the others take a matrix product."""
    own, asked, vectors = shard
    questions = blockmax.Questions.of(Weights(asked))
    names, want = questions.names.to_pylist(), brute(asked, vectors, 3)
    ways = []
    own._in_whole, kept = lambda *a: (ways.append(a[1:3]), kept(*a))[1], own._in_whole
    best, total, read = own.search(questions, 3, blockmax.RANGE)
    own._in_whole = kept
    assert ways == [(blockmax.PROBED, len(names))] and read > 0.5 * total
    assert hits(best, names) == want
    assert hits(own.search_in_whole(questions, 3), names) == want
    floors = dict(zip(names, own.search_in_whole(questions, 3).score[:, 2]))
    assert hits(own.search(questions.above(floors), 3, blockmax.RANGE)[0], names) == want


def test_questions_are_taken_in_slices_of_bounded_work(shard, monkeypatch):
    """F7, F8: the blocks and postings of long questions bound a slice, not only its documents."""
    own, asked, vectors = shard
    monkeypatch.setattr(blockmax, "ITEMS", 2_000)
    items = np.full(300, 150)
    slices = list(own._slices(np.repeat(np.arange(100), 3), items, 10, 100))
    assert slices[0][0] == 10 and slices[-1][1] == 100
    assert all(a[1] == b[0] for a, b in zip(slices, slices[1:]))
    assert all((high - low) * 450 <= 2_000 for low, high in slices)
    questions = blockmax.Questions.of(Weights(asked))
    assert hits(own.search(questions, 3, blockmax.RANGE)[0], questions.names.to_pylist()) == brute(asked, vectors, 3)


def test_search_writes_one_layout_of_postings(spark):
    """blocks alone; the folders that SQL reads are written when it asks for them."""
    rows = [(i, f"red w{i % 7} w{i % 5} red") for i in range(60)]
    corpus = spark.createDataFrame(rows, "id bigint, text string")

    def tables():
        return {x.name for x in spark.catalog.listTables() if x.name.startswith("postings_")}

    before = tables()
    stored = postings.store(corpus, postings_per_folder=50)
    asked = spark.createDataFrame([(1, "w3 red")], "query_id int, text string")
    assert postings.search(asked, stored, 2).count() == 2 and tables() == before
    assert set(stored.blocks.columns) == {"shard", "term", "ids", "docs", "weights"}
    got = sorted(tuple(r) for r in stored.postings.select("id", "term", "weight").collect())
    assert got == sorted(tuple(r) for r in postings.weighted(corpus).select("id", F.inline("pairs")).collect())
    assert stored.folders > 1 and len(tables()) == len(before) + 1 and stored.postings is stored.postings
    assert {r.term: r.df for r in stored.terms.collect()}["red"] == 60


def test_texts_are_dealt_once(spark):
    """texts travel to their shards, and their words are counted there."""
    corpus = spark.createDataFrame([(i, f"red w{i}") for i in range(40)], "id bigint, text string")
    made = blockmax.blocks(corpus, 4, words=postings.words_of(F.col("text")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ArrowEvalPython" not in plan
    same = blockmax.blocks(postings.weighted(corpus), 4)
    assert sorted(map(str, made.collect())) == sorted(map(str, same.collect()))


def test_nested_embeddings_are_searched_without_gathering_them(spark):
    """F5"""
    texts = spark.createDataFrame([(1, "red fox red"), (2, "blue sea"), (3, "red sea"), (4, ""), (5, None)], "id int, text string")
    model = embed.fit(texts, 1 << 12)
    flat, nested = (embed.embed_hashed(texts, model, 1 << 12, nested=x) for x in (False, True))
    assert sorted(nested.select("id", F.inline("pairs")).collect()) == sorted(flat.collect())
    assert embed.postings_of(model) == flat.count()
    asked = flat.withColumnRenamed("id", "query_id")
    want = sorted(tuple(r) for r in embed.search_sparse(asked, flat, 2).collect())
    for size in (None, (5, 6)):
        assert sorted(tuple(r) for r in embed.search_sparse(asked, nested, 2, size).collect()) == want


def test_blocks_copy_the_corpus_once(spark, monkeypatch):
    """however many queries exceed the limit, as long as a task can hold them."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(300)], "id int, v array<double>")
    seen, score = [], vector._score_blocks
    monkeypatch.setattr(vector, "_score_blocks", lambda a, b, *more: (seen.append(b.count()), score(a, b, *more))[1])
    asked = df.withColumnRenamed("id", "query_id")
    got = vector.knn_exact(asked, df, 2, limit=500).collect()
    assert seen == [300]
    assert sorted(map(tuple, got)) == sorted(map(tuple, vector.knn_exact(asked, df, 2).collect()))


def test_the_first_index_is_built_from_its_version(spark, sf):
    """nothing is written before it that it does not need."""
    gold = spark.createDataFrame([("a", "x", "text x"), ("b", "x", "text x"), ("b", "y", "text y")], "path string, chunk_id string, chunked_text string")
    feed = index.change_feed(gold.limit(0), gold)
    assert sorted(index.apply_changes(None, gold, feed).collect()) == sorted(index.build_index(gold).collect())
    before = {key for key in t._written if key[3].startswith("gold-v")}
    assert q.stream_index_feed(spark, sf).count()
    assert {key for key in t._written if key[3].startswith("gold-v")} == before


def test_ids_without_a_key_are_carried_over(spark):
    """touched ids travel as 64 bits."""
    schema = "path string, chunk_id string, chunked_text string"
    old = spark.createDataFrame([("a", "x", "text x"), ("b", "y", "text y")], schema)
    new = spark.createDataFrame([("a", "x", "text x"), ("c", "y", "text y")], schema)
    keyless = spark.createDataFrame([(None, "none", "p", 1)], "chunk_id string, chunked_text string, path string, n_sources bigint")
    got = index.apply_changes(index.build_index(old).unionByName(keyless), new, index.change_feed(old, new))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("x", "text x", "a", 1), ("y", "text y", "c", 1), (None, "none", "p", 1)], key=str
    )
