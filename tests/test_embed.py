from __future__ import annotations

import hashlib
import sys
import time
import tracemalloc

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from plaint.operators import embed, summaries

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "ticket_id string, timestamp timestamp, comment string, photo string"
TICKETS = [
    ("t1", None, "one", "u1"),
    ("t1", None, "one again", "u1"),
    ("t2", None, None, "u2"),
    ("t3", None, "no such photo", "u9"),
    ("t4", None, "empty photo", "u3"),
    ("t5", None, "broken photo", "u4"),
    ("t6", None, "bad text", "u1"),
    ("", None, "no id", "u1"),
    (None, None, "no id", "u1"),
    ("t7", None, "no url", ""),
    ("t8", None, "no url", None),
]
PHOTOS = [("u1", b"abc"), ("u2", b"xyz"), ("u3", b""), ("u4", b"broken"), ("u5", b"not shown"), (None, b"x"), ("", b"x")]


def text_factory():
    def run(values):
        if "bad text" in values:
            raise ValueError("bad")
        return [[float(len(v)), 0.0] for v in values]

    return run


def image_factory():
    def run(values):
        if b"broken" in values:
            raise ValueError("cannot decode")
        return np.array([[0.0, float(v[0])] for v in values])

    return run


@pytest.fixture
def frames(spark):
    return spark.createDataFrame(TICKETS, SCHEMA), spark.createDataFrame(PHOTOS, "url string, content binary")


@pytest.mark.parametrize("parallelism", [None, 3])
def test_vectors_and_rejects(frames, parallelism):
    found = embed.vectorize_tickets(*frames, text_factory, image_factory, parallelism=parallelism)
    assert found.columns == ["ticket_id", "timestamp", "comment", "photo", "vector", "reject_reason"]
    rows = found.collect()
    assert len(rows) == len(TICKETS)
    assert all((r.vector is None) != (r.reject_reason is None) for r in rows)
    reasons = {(r.ticket_id, r.comment): r.reject_reason for r in rows}
    assert reasons["t3", "no such photo"] == reasons["t4", "empty photo"] == "photo not available"
    assert reasons["t5", "broken photo"] == "embedding failed: cannot decode"
    assert reasons["t6", "bad text"] == "embedding failed: bad"
    assert reasons["", "no id"] == reasons[None, "no id"] == "missing ticket_id"
    assert reasons["t7", "no url"] == reasons["t8", "no url"] == "missing photo"
    vectors = {(r.ticket_id, r.comment): r.vector for r in rows if r.vector}
    assert set(vectors) == {("t1", "one"), ("t1", "one again"), ("t2", None)}
    assert vectors["t2", None] == [0.0, 0.0, 0.0, 1.0]
    length = (9 + 97.0**2) ** 0.5
    assert np.allclose(vectors["t1", "one"], [3 / length, 0, 0, 97 / length])


def test_a_photo_that_is_listed_twice_counts_once(spark):
    tickets = spark.createDataFrame([("t1", None, "c", "u1")], SCHEMA)
    photos = spark.createDataFrame([("u1", b"abc"), ("u1", b"abd"), ("u1", b"")], "url string, content binary")
    assert embed.vectorize_tickets(tickets, photos).count() == 1


def test_no_photo_bytes_are_shuffled(frames, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = embed.vectorize_tickets(*frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [line.index("Exchange") for line in plan.splitlines() if "Exchange" in line]
    assert depth
    kernels = [i for i, line in enumerate(plan.splitlines()) if "ArrowEvalPython" in line and "content" in line]
    below = [line for line in plan.splitlines()[kernels[-1] + 1 :]]
    # The photos' branch comes first and has no exchange; the other one brings hashes of urls.
    hashes = next(i for i, line in enumerate(below) if "BroadcastExchange" in line)
    assert not any("Exchange" in line for line in below[:hashes])
    assert any("content" in line for line in below[:hashes]) and not any("content" in line for line in below[hashes:])


def test_a_filter_on_the_result_does_not_run_the_model_again(spark, tmp_path):
    log = str(tmp_path)

    def factory():
        def run(values):
            for value in values:
                with open(f"{log}/{hashlib.md5(value.encode()).hexdigest()}", "a") as calls:
                    calls.write("x")
            return [[1.0] for _ in values]

        return run

    frame = spark.createDataFrame([(f"c{i}",) for i in range(20)], "comment string")
    found = embed.embed_text(frame, factory=factory)
    assert found.filter("text_vector_error is null and text_vector is not null").count() == 20
    assert [p.read_text() for p in tmp_path.iterdir()] == ["x"] * 20


def test_a_model_is_loaded_once_per_task_and_called_in_batches(spark, tmp_path):
    log = str(tmp_path / "log")

    def factory():
        with open(log, "a") as calls:
            calls.write("load\n")

        def run(values):
            with open(log, "a") as calls:
                calls.write(f"{len(values)}\n")
            return [[1.0] for _ in values]

        return run

    frame = spark.createDataFrame([(f"c{i}",) for i in range(25)], "comment string").coalesce(1)
    embed.embed_text(frame, factory=factory, batch_size=10).collect()
    assert open(log).read().split() == ["load", "10", "10", "5"]


def test_one_bad_value_rejects_only_itself(spark):
    def factory():
        def run(values):
            return [[1.0 / (v != "bad")] for v in values]

        return run

    frame = spark.createDataFrame([("a",), ("bad",), ("c",), (None,)], "comment string").coalesce(1)
    rows = embed.embed_text(frame, factory=factory).collect()
    assert [r.text_vector for r in rows] == [[1.0], None, [1.0], [1.0]]
    assert rows[1].text_vector_error.startswith("embedding failed")


def test_too_few_vectors_are_rejected(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "comment string").coalesce(1)
    rows = embed.embed_text(frame, factory=lambda: lambda values: []).collect()
    assert all(r.text_vector is None and "0 vectors for 1 values" in r.text_vector_error for r in rows)


def test_default_embedders(spark):
    texts = ["", "a", "น้ำท่วม road 7", "x" * 5000]
    frame = spark.createDataFrame([(t,) for t in texts], "comment string")
    for text, row in zip(texts, embed.embed_text(frame).collect()):
        counts = np.zeros(64)
        code = [ord(c) for c in f" {text} "]
        for a, b, c in zip(code, code[1:], code[2:]):
            counts[(a * 961 + b * 31 + c) % 64] += 1
        length = np.linalg.norm(counts)
        assert np.allclose(row.text_vector, counts / length if length else counts)
    data = bytes(range(256)) * 2 + b"\x00" * 100
    frame = spark.createDataFrame([(bytearray(data),)], "content binary")
    counts = np.array([8.0] * 64) + np.array([100.0] + [0.0] * 63)
    assert np.allclose(embed.embed_image(frame).first().image_vector, counts / np.linalg.norm(counts))


def test_attached_bytes_are_empty_where_missing(frames):
    found = embed.attach_photo_bytes(*frames, spread_by=["comment"])
    assert found.columns == ["ticket_id", "timestamp", "comment", "photo", "content"]
    content = {(r.ticket_id, r.comment): bytes(r.content) for r in found.collect()}
    assert content["t1", "one"] == b"abc" and content["t3", "no such photo"] == b""
    assert content["t7", "no url"] == content["t8", "no url"] == b"" and len(content) == len(TICKETS)


def test_summaries_by_callable_and_fallback(spark):
    frame = spark.createDataFrame(
        [("t1", "1", "good"), ("t2", "1", "better"), ("t3", "2", "raise")], "ticket_id string, cluster string, comment string"
    )

    def summarizer(prompt):
        if "raise" in prompt:
            raise TimeoutError
        time.sleep(0.01)
        return f"  {len(prompt.splitlines())} lines  "

    found = summaries.summarize_clusters(frame, summarizer, instruction="Say:")
    assert {r.cluster: r.summary for r in found.collect()} == {
        "1": "4 lines", "2": "Summary not available"
    }


def test_central_comment_without_a_callable(spark):
    frame = spark.createDataFrame(
        [("t1", "1", "edge", [0.0]), ("t2", "1", "middle", [1.0]), ("t3", "1", "edge", [2.1]),
         ("t4", "1", "none", None), ("t5", "2", None, [7.0]), ("t6", None, "x", [1.0])],
        "ticket_id string, cluster string, comment string, vector array<double>",
    )
    found = summaries.summarize_clusters(frame)
    assert {r.cluster: r.summary for r in found.collect()} == {"1": "middle", "2": ""}


def test_batches_without_any_vector(spark):
    frame = spark.createDataFrame([(None,), (None,)], "content binary").coalesce(1)
    rows = embed.embed_image(frame, factory=image_factory).collect()
    assert [(r.image_vector, r.image_vector_error) for r in rows] == [(None, None)] * 2


def test_vectors_of_unequal_width_keep_their_rows(spark):
    frame = spark.createDataFrame([("",), ("abc",), ("x",)], "comment string").coalesce(1)
    rows = embed.embed_text(frame, factory=lambda: lambda vs: [[1.0] * len(v) for v in vs]).collect()
    assert [r.text_vector for r in rows] == [[], [1.0] * 3, [1.0]]


def test_empty_input(frames):
    tickets, photos = frames
    assert embed.vectorize_tickets(tickets.limit(0), photos).collect() == []
    assert embed.vectorize_tickets(tickets, photos.limit(0)).filter(F.col("vector").isNotNull()).count() == 0


def test_long_texts_of_a_call_are_counted_in_parts(monkeypatch):
    model, values = embed.trigram_embedder()(), ["abc" * n + "\u00e9" for n in range(40_000, 40_064)]
    tracemalloc.start()
    found = model(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    monkeypatch.setattr(embed, "CHARS", 10**9)
    assert np.array_equal(found, model(values))


def test_batches_are_not_made_python_objects_as_a_whole(spark, frames):
    """Calls still get ``batch_size`` given values each, and NULLs stay NULL."""

    def factory():
        return lambda values: [[float(len(values))] for _ in values]

    rows = spark.createDataFrame([(n, None if n % 3 == 0 else "x") for n in range(30)], "n int, x string").coalesce(1)
    found = embed.embed(rows, "x", "v", factory, batch_size=8).collect()
    assert [r.v for r in found if r.n % 3 == 0] == [None] * 10
    assert [r.v[0] for r in found if r.v] == [8.0] * 16 + [4.0] * 4
