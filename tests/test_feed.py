"""An index that follows the change feed of gold versions."""

import os

import pytest

from docloom.operators import index
from docloom.streaming import feed

SCHEMA = "path string, chunk_id string, chunked_text string"


def gold(spark, *chunks):
    return spark.createDataFrame([(p, f"id-{c}", c) for p, c in chunks], SCHEMA)


VERSIONS = [
    [("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")],
    [("a", "y"), ("b", "x"), ("c", "w")],
    [("a", "y"), ("b", "x"), ("c", "w")],
    [("b", "v")],
    [("b", "v"), ("d", "x"), ("a", "x"), ("a", "x")],
]


def rows(df):
    return sorted(tuple(r) for r in df.select("chunk_id", "chunked_text", "path", "n_sources").collect())


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / x) for x in ("versions", "index", "checkpoint")]


def test_equals_the_index_of_every_version(spark, places):
    folder, out, checkpoint = places
    for n, chunks in enumerate(VERSIONS, 1):
        assert feed.publish(gold(spark, *chunks), folder) == n
        feed.follow(spark, folder, out, checkpoint)
        assert rows(feed.newest_index(spark, out)) == rows(index.build_index(gold(spark, *chunks)))
    # the third version changed nothing
    assert sorted(os.listdir(out)) == ["1", "2", "4", "5"]


def test_several_versions_at_once_and_a_restart(spark, places):
    folder, out, checkpoint = places
    for chunks in VERSIONS[:3]:
        feed.publish(gold(spark, *chunks), folder)
    feed.follow(spark, folder, out, checkpoint)
    assert rows(feed.newest_index(spark, out)) == rows(index.build_index(gold(spark, *VERSIONS[2])))
    times = {d: os.stat(f"{out}/{d}").st_mtime_ns for d in os.listdir(out)}
    feed.follow(spark, folder, out, checkpoint)
    assert {d: os.stat(f"{out}/{d}").st_mtime_ns for d in os.listdir(out)} == times
    for chunks in VERSIONS[3:]:
        feed.publish(gold(spark, *chunks), folder)
    feed.follow(spark, folder, out, checkpoint)
    assert rows(feed.newest_index(spark, out)) == rows(index.build_index(gold(spark, *VERSIONS[4])))


def test_a_half_written_version_is_not_seen(spark, places):
    folder, out, checkpoint = places
    feed.publish(gold(spark, *VERSIONS[0]), folder)
    gold(spark, ("q", "half")).write.parquet(f"{folder}/gold/2")
    gold(spark, ("q", "half")).write.parquet(f"{folder}/changes/2")
    assert feed.latest_version(folder) == 1
    feed.follow(spark, folder, out, checkpoint)
    assert os.listdir(out) == ["1"]
    assert feed.publish(gold(spark, *VERSIONS[1]), folder) == 2
    feed.follow(spark, folder, out, checkpoint)
    assert rows(feed.newest_index(spark, out)) == rows(index.build_index(gold(spark, *VERSIONS[1])))


def test_a_repeated_batch_replaces_its_index(spark, places):
    """The checkpoint is lost after the batch: all versions come again, to the same end."""
    folder, out, checkpoint = places
    for chunks in VERSIONS[:2]:
        feed.publish(gold(spark, *chunks), folder)
    feed.follow(spark, folder, out, checkpoint)
    feed.follow(spark, folder, out, checkpoint + "-new")
    assert rows(feed.newest_index(spark, out)) == rows(index.build_index(gold(spark, *VERSIONS[1])))


def test_the_source_counts_versions(tmp_path):
    reader = feed.ChangeReader(str(tmp_path))
    assert reader.initialOffset() == {"version": 0} == reader.latestOffset()
    assert reader.partitions({"version": 0}, {"version": 0}) == []
