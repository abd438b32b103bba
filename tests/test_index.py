from pyspark.sql import functions as F

from docloom.operators import embed, index
from docloom.plans import clients

GOLD = "path string, chunk_id string, chunked_text string"


def gold(spark, rows):
    return spark.createDataFrame([(p, t, "text " + t) for p, t in rows], GOLD)


def test_one_row_per_id(spark):
    rows = [("b", "x"), ("a", "x"), ("a", "x"), ("a", "y")] + [(f"z{i}", "x") for i in range(500)]
    got = {r.chunk_id: (r.path, r.n_sources, r.chunked_text) for r in index.build_index(gold(spark, rows)).collect()}
    assert got == {"x": ("a", 502, "text x"), "y": ("a", 1, "text y")}


def test_changes(spark):
    old = gold(spark, [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x")])
    new = gold(spark, [("a", "x"), ("a", "z"), ("c", "x")])
    feed = index.change_feed(old, new)
    assert sorted(tuple(r) for r in feed.collect()) == [
        ("a", "y", "delete"),
        ("a", "z", "insert"),
        ("b", "x", "delete"),
        ("c", "x", "insert"),
    ]
    applied = index.apply_changes(index.build_index(old), new, feed)
    assert sorted(applied.collect()) == sorted(index.build_index(new).collect())


def test_untouched_entries_are_carried_over(spark):
    old = gold(spark, [("a", "x"), ("b", "y")])
    new = gold(spark, [("a", "x"), ("c", "y")])
    marked = index.build_index(old).withColumn("chunked_text", F.concat(F.lit("old "), "chunked_text"))
    got = {r.chunk_id: (r.chunked_text, r.path) for r in index.apply_changes(marked, new, index.change_feed(old, new)).collect()}
    assert got == {"x": ("old text x", "a"), "y": ("text y", "c")}
    same = index.apply_changes(marked, old, index.change_feed(old, old))
    assert sorted(same.collect()) == sorted(marked.collect())


def test_embeddings(spark):
    chunks = index.build_index(gold(spark, [("a", "x y"), ("b", "bee tree")]))
    got = {r.chunk_id: list(r.embedding) for r in embed.embed(chunks, clients.letters, batch=1).collect()}
    assert got == {"x y": [8.0, 2.0, 1.0], "bee tree": [13.0, 2.0, 5.0]}


def test_hashed_embeddings(spark):
    rows = [(1, "red fox red"), (2, "blue sea"), (3, "red sea"), (4, ""), (5, None)]
    texts = spark.createDataFrame(rows, "id int, text string")
    model = embed.fit(texts, 1 << 18)
    hashed = embed.embed_hashed(texts, model, 1 << 18)
    norms = hashed.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n"), F.count("*").alias("k")).collect()
    assert {(r.id, r.k) for r in norms} == {(1, 2), (2, 2), (3, 2)} and all(abs(r.n - 1) < 1e-9 for r in norms)
    hits = embed.search_sparse(hashed.withColumnRenamed("id", "query_id"), hashed, 1).collect()
    assert {(r.query_id, r.id, r.score) for r in hits} == {(i, i, 1.0) for i in (1, 2, 3)}
