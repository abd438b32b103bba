"""Cleaning up after an application, in one of its own as others share theirs."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
from docloom import session
from docloom.operators import postings
from docloom.plans import tables
conf = {"spark_checkpoint_dir": sys.argv[1]} if len(sys.argv) > 1 else {}
spark = session.build("clean", "local[2]", spark_sql_shuffle_partitions="2", spark_ui_enabled="false", **conf)
corpus = spark.createDataFrame([(1, "red fox"), (2, "blue")], "id int, text string")
make = lambda: corpus.select("id")
for turn in range(2):
    stored = postings.store(corpus)
    kept = tables.written(spark, "x", "ids", make)
    asked = spark.createDataFrame([(1, "fox")], "query_id int, text string")
    assert [r.id for r in postings.search(asked, stored, 1).collect()] == [1]
    assert kept.count() == 2 and tables.written(spark, "x", "ids", make) is kept
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(session.STORED)]) == 2
    session.clean(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(session.STORED)]
print("clean")
"""


def test_clean_leaves_nothing_and_what_follows_starts_anew(tmp_path):
    work = tmp_path / "work"
    env = os.environ | {"PYTHONPATH": ROOT}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(work)], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert "clean" in done.stdout, done.stderr[-3000:]
    assert os.listdir(work / "docloom") == []
