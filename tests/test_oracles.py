"""Every query beside its SQL, on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_queries import compare, compare_types, connect
from plaint.checks.oracles import ORACLES
from plaint.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    rows = [tuple(row) for row in found.collect()]
    assert rows
    result = duck.execute(entry.oracle_sql()[name])
    description = result.description
    problem = compare(found.columns, rows, [d[0] for d in description], result.fetchall())
    assert not problem
    assert not compare_types(found.dtypes, description)


def test_entry(spark):
    counts = [row["count"] for row in entry.entry(spark).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 200


def test_the_rest_works_without_the_text_operators(tmp_path):
    """A copy of the repository without the llm folders and the pipeline imports and registers."""
    root = Path(entry.__file__).resolve().parent
    keep = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(root, tmp_path / "copy", ignore=keep)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr
