"""The entry point with and without the corpus operators' folder."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from kelda.plans import ALL_QUERIES

ROOT = Path(entry.__file__).parent


def test_queries_without_the_corpus_operators(tmp_path):
    """As after the folders are deleted, with compiled files left behind in one of them."""
    copy = tmp_path / "repo"
    copy.mkdir()
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    shutil.copytree(ROOT / "kelda", copy / "kelda", ignore=lambda folder, names: ["llm"] if folder.endswith("kelda") else [])
    left = copy / "kelda" / "llm" / "__pycache__"
    left.mkdir(parents=True)
    (left / "plans.cpython-313.pyc").write_bytes(b"old")
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert run.stdout.split() == [str(len(ALL_QUERIES))] * 2


def test_all_queries_are_there():
    assert ALL_QUERIES.items() <= entry.queries().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())
