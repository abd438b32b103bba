import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.operators import chunk
from docloom.operators.extract import parsed

EDGES = {
    "empty": "",
    "exact": "a" * 1000,
    "one over, no gap": "b" * 1001,
    "blank lines": ("word " * 60 + "\n\n") * 9,
    "only gaps": " \n" * 700,
    "gap in the overlap only": "c" * 100 + " " + "d" * 2400,
    "emoji": "😀 smile " * 300,
    "combining": "éà " * 400,
    "line ends": "one line here\r\n" * 200,
}


def silver(spark, texts):
    rows = [(k, v) for k, v in texts.items()]
    return spark.createDataFrame(rows, "path string, text string").select(
        "path", parsed(F.lit("1"), F.col("text")).alias("doc_parsed_contents")
    )


def chunks_of(gold):
    out = {}
    for r in sorted(gold.collect(), key=lambda r: (r.path, r.chunk_pos)):
        out.setdefault(r.path, []).append(r)
    return out


def covers(text, pieces):
    """Taken in order, each chunk starts no later than the first character not yet covered, gaps aside."""
    at = 0
    for p in pieces:
        while at < len(text) and text[at] in " \n":
            at += 1
        start = text.rfind(p, 0, at + len(p))
        if start < 0:
            return False
        at = max(at, start + len(p))
    return not text[at:].strip(" \n")


def test_boundary_invariants(spark):
    got = chunks_of(chunk.gold(silver(spark, EDGES)))
    assert "empty" not in got and "only gaps" not in got
    for path, rows in got.items():
        text, pieces = EDGES[path], [r.chunked_text for r in rows]
        assert [r.chunk_pos for r in rows] == list(range(len(rows)))
        assert all(0 < len(p) <= 1000 and p in text for p in pieces)
        assert covers(text, pieces)
        assert all(r.chunk_id == hashlib.md5(r.chunked_text.encode()).hexdigest() for r in rows)
    assert len(got["exact"]) == 1
    assert [len(r.chunked_text) for r in got["one over, no gap"]] == [1000, 151]
    assert all(r.chunked_text.endswith("word") for r in got["blank lines"])


def test_fixed_is_plain_windows(spark):
    got = chunks_of(chunk.gold(silver(spark, EDGES), chunk.fixed_chunks()))
    for path, text in EDGES.items():
        n = len(text)
        count = max(1, -(-(n - 150) // 850)) if n else 0
        want = [text[i * 850 : i * 850 + 1000] for i in range(count)]
        assert [r.chunked_text for r in got.get(path, [])] == want


@pytest.mark.parametrize("size, overlap", [(10, 0), (10, 3), (10, 8), (7, 5)])
def test_other_parameters(spark, size, overlap):
    text = "the quick brown fox jumps over the lazy dog\n\nand naps"
    df = silver(spark, {"t": text})
    step = size - overlap
    count = max(1, -(-(len(text) - overlap) // step))
    fixed = [r.chunked_text for r in chunks_of(chunk.gold(df, chunk.fixed_chunks(size, overlap)))["t"]]
    assert fixed == [text[i * step : i * step + size] for i in range(count)]
    pieces = [r.chunked_text for r in chunks_of(chunk.gold(df, chunk.boundary_chunks(size, overlap)))["t"]]
    assert all(len(p) <= size for p in pieces) and covers(text, pieces)


def test_bad_parameters():
    for make in (chunk.boundary_chunks, chunk.fixed_chunks):
        with pytest.raises(ValueError):
            make(100, 100)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \né", max_size=200), st.integers(2, 30), st.data())
def test_boundary_rule(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    pieces = chunk.split_boundary(text, size, overlap)
    assert all(0 < len(p) <= size and p in text for p in pieces)
    assert covers(text, pieces)


def test_partitioning_changes_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("path"), parsed(F.lit("1"), F.col("text")).alias("doc_parsed_contents")
    )
    assert sorted(chunk.gold(docs).collect()) == sorted(chunk.gold(docs.repartition(7)).collect())


def test_texts_are_split_once(spark):
    """No filter below the generator runs the splitter a second time."""
    df = chunk.gold(silver(spark, EDGES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_dropped_docs(spark):
    df = silver(spark, EDGES).withColumn("parser_status", F.lit("SUCCESS"))
    got = chunk.dropped_docs(df, chunk.gold(df)).collect()
    assert sorted(r.path for r in got) == ["empty", "only gaps"]
