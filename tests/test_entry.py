"""The entry module without the folders that may be missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_import_without(tmp_path, gone):
    skip = shutil.ignore_patterns("__pycache__", *gone)
    shutil.copytree(os.path.join(ROOT, "docloom"), tmp_path / "docloom", ignore=skip)
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(gone):
        shutil.copy(os.path.join(ROOT, name), tmp_path / name)
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    queries, oracle = done.stdout.split("\n")[:2]
    assert "rag_context" in queries and "rag_context" in oracle and "pipeline" not in queries
    assert not [q for q in queries.split() if q.startswith("op")] or "llm" not in gone
