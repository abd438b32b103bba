import os
import re

import pytest
from pyspark.sql import functions as F

from docloom import session
from docloom.operators import chunk, extract
from docloom.sources import files, tables
from docloom.streaming import ingest


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_scan_is_recursive_and_case_sensitive(spark, tmp_path):
    for name in ("a.html", "sub/b.html", "C.HTML", "d.txt"):
        write(str(tmp_path), name, "x" * len(name))
    df = files.read_files(spark, str(tmp_path), "*.html")
    assert df.columns == ["path", "modificationTime", "length", "content"]
    assert sorted(os.path.basename(r.path) for r in df.collect()) == ["a.html", "b.html"]
    plan = df.drop("content").where("length > 1")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert "GreaterThan(length,1)" in plan


def test_last_entry_wins(spark):
    rows = [(0, "a", "u0"), (1, "b", "u1"), (2, "b", "u2"), (3, "c", "u3"), (4, "a", "u4"), (5, "c", "u5")]
    df = spark.createDataFrame(rows, "ord int, name string, url string").repartition(3)
    got = sorted((r.name, r.url, r.ord) for r in tables.last_wins(df, "name", "ord").collect())
    assert got == [("a", "u4", 4), ("b", "u2", 2), ("c", "u5", 5)]


def test_landing(spark):
    manifest = spark.createDataFrame([("a", "ua"), ("b", "ub")], "name string, url string")
    landed = spark.createDataFrame([("a", 3), ("a", 4), ("x", 9)], "name string, length bigint")
    got = {r.name: (r.status, r.landed_files, r.landed_bytes) for r in files.landing_status(manifest, landed).collect()}
    assert got == {"a": ("LANDED", 2, 7), "b": ("MISSING", 0, 0)}


def test_overwrite_replaces_schema(spark):
    schema = tables.scratch_schema(spark, "docloom_test")
    tables.overwrite_table(spark.range(3), f"{schema}.t")
    back, n = tables.overwrite_counted(spark.createDataFrame([("x",)], "name string"), f"{schema}.t")
    assert back.columns == ["name"] and n == 1 and back.count() == 1


def test_current_namespace(spark):
    user = spark.sql("SELECT current_user()").first()[0]
    assert tables.current_namespace(spark) == re.sub(r"[^\w]", "_", user.split("@")[0])


def test_work_dir_is_needed_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        session.work_dir(Session())


def test_broadcast_only_when_small(spark):
    df = spark.range(1000)
    assert session.measured(df) == (1000, 24_000)
    hinted = session.broadcast_if_small(df, 24_000)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted
    assert "broadcast" not in session.broadcast_if_small(df, 23_999)._jdf.queryExecution().logical().toString()


def page(words):
    return "<html><p>" + " ".join(words) + "</p></html>"


def test_stream_takes_new_files_only(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))

    def run():
        ingest.stream_gold(ingest.stream_files(spark, src, "*.html"), extract.silver, out, cp)

    def batches():
        return sorted(os.listdir(os.path.join(out, "chunks")))

    write(src, "one.html", page(["alpha"] * 400))
    run()
    write(src, "two.html", page(["beta"] * 300))
    run()
    seen = batches()
    run()
    assert batches() == seen  # nothing new, nothing written
    batch = chunk.gold(extract.silver(files.read_files(spark, src, "*.html")))
    got = ingest.read_gold(spark, out).select(batch.columns)
    assert sorted(got.collect()) == sorted(batch.collect())


def test_newest_version_of_a_path(spark):
    versions = spark.createDataFrame(
        [("a", "old", 0), ("a", "new", 1), ("b", "kept", 0), ("c", "gone", 0)], "path string, chunk_id string, batch_id int"
    )
    paths = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0), ("a", 1), ("c", 1)], "path string, batch_id int")
    got = sorted(r.chunk_id for r in ingest.latest(versions, paths).collect())
    assert got == ["kept", "new"]  # c's newest version has no chunk


def test_unsplittable_input_is_spread(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(df, "doc_id").rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 1)
    assert session.spread(wide, "id") is wide
    assert session.spread(df, "doc_id").agg(F.count("*")).first()[0] == df.count()


def test_measured_counts_nested_values(spark):
    long = "x" * 1000
    df = spark.createDataFrame(
        [(long, [long, long], {"k": long}, (long, 1), [(long, 2)]), (None, None, None, None, None)],
        "s string, a array<string>, m map<string, string>, t struct<s: string, i: int>, n array<struct<s: string, i: int>>",
    )
    rows, size = session.measured(df)
    assert rows == 2 and 6000 < size < 7000


def test_intermediates_lie_in_the_applications_folder(spark, tmp_path, monkeypatch):
    left = session.materialise(spark.range(3), "left")
    assert left.count() == 3 and all(spark.sparkContext.applicationId in f for f in left.inputFiles())
    monkeypatch.setattr(session, "own_folder", lambda s: str(tmp_path / "own"))
    (tmp_path / "own" / "old").mkdir(parents=True)
    (tmp_path / "other").mkdir()
    session.clean(spark)
    assert not (tmp_path / "own").exists() and (tmp_path / "other").exists()
