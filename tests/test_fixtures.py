"""The tickets that queries are run on: read as needed, not copied."""

from __future__ import annotations

import pytest

from plaint import fixtures
from plaint.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["assign_clusters", "fetch_photos", "summarize_with_callable"])
def test_queries_do_not_copy_all_tickets(spark, name, monkeypatch):
    monkeypatch.setattr(fixtures, "_WRITTEN", {})
    assert QUERIES[name](spark, SF_DIR).count()
    assert not fixtures._WRITTEN


def test_texts_are_not_sorted_for_their_times(spark):
    found = fixtures.tickets(spark, SF_DIR).select("doc_id", "comment", "timestamp")
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # Where no time or state is asked for, no event is read.
    alone = fixtures.tickets(spark, SF_DIR).select("doc_id", "comment")
    assert "Join" not in alone._jdf.queryExecution().optimizedPlan().toString()
