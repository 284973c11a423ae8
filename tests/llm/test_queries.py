"""Every registered query of the text operators beside its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from check_queries import compare, compare_types, connect
from plaint.llm.oracles import ORACLES
from plaint.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_numbers_and_sql():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(ORACLES) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in found.collect()]
    assert rows
    if name not in ORACLES:
        return
    connection = connect(SF_DIR)
    result = connection.execute(ORACLES[name])
    description = result.description
    problem = compare(found.columns, rows, [d[0] for d in description], result.fetchall())
    connection.close()
    assert not problem
    assert not compare_types(found.dtypes, description)
