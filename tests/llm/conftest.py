from __future__ import annotations

import pytest

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A frame of documents from texts (ids from 0) or (id, text) pairs, with clashing extra columns."""

    def make(rows, parts=3):
        pairs = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        full = [(i, t, "en" if n % 2 else None, None, len(t or "")) for n, (i, t) in enumerate(pairs)]
        frame = spark.createDataFrame(full, DOCS_DDL).repartition(parts)
        clashing = ("uid", "n_words", "key", "bucket", "kind", "rep", "shard", "slot", "size", "score", "words", "n", "curve")
        return frame.selectExpr("*", *[f"'x' as {name}" for name in clashing])

    return make
