"""Places on the Hilbert curve, and the law of equal row counts."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from plaint.llm import sharding


def test_the_curve_visits_every_cell_by_single_steps(spark):
    for count, bits in ((2, 3), (3, 2)):
        cells = list(itertools.product(range(1 << bits), repeat=count))
        frame = spark.createDataFrame(cells, ", ".join(f"x{i} long" for i in range(count)))
        index = sharding.hilbert_index([F.col(f"x{i}") for i in range(count)], bits)
        placed = {r[-1]: r[:-1] for r in frame.withColumn("at", index).collect()}
        assert sorted(placed) == list(range(len(cells)))
        for a, b in itertools.pairwise(placed[i] for i in range(len(cells))):
            assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def check(rows, placed, shards=8):
    assert sorted((str(p.doc_id), p.size, p.text_crc32) for p in placed) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for p in placed:
        assert p.law == "rows" and p.grown_shard is None and 0 <= p.shard < shards
        slots[p.shard].append((p.slot, p.curve))
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    order = []
    for s in range(shards):
        own = sorted(slots[s])
        assert [slot for slot, _ in own] == list(range(len(own)))
        order += [curve for _, curve in own]
    assert order == sorted(order)


def test_counts_and_slots(docs):
    for n in (1, 7, 8, 9, 100, 101):
        rows = [(i, "x" * (i * 7 % 50)) for i in range(n)]
        check(rows, sharding.hilbert_shards(docs(rows)).collect())


def test_odd_rows(docs):
    rows = [(None, None), (None, "a"), (1, None), (2, ""), (3, "é" * 5000)] + [(4, "same")] * 40
    check(rows, sharding.hilbert_shards(docs(rows)).collect())


def test_empty_table(docs):
    assert sharding.hilbert_shards(docs([(1, "x")]).limit(0)).collect() == []


def test_written_shards(docs, tmp_path):
    rows = [(i, "t" * i) for i in range(40)]
    frame = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    path = str(tmp_path / "shards")
    sharding.write_shards(frame, path)
    read = frame.sparkSession.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in read.collect()) == rows
    assert {r["count"] for r in read.groupBy("shard").count().collect()} == {5}


def test_written_rows_are_the_rows(docs, tmp_path):
    """Repeated ids and rows, rows without an id, and columns that clash, some by name alone."""
    rows = [(5, "a")] * 3 + [(5, "b"), (None, "c"), (None, "c"), (None, None), (6, "d")]
    for frame in (docs(rows), docs(rows).drop("shard").withColumnRenamed("kind", "_at")):
        path = str(tmp_path / f"shards-{'shard' in frame.columns}")
        sharding.write_shards(frame, path)
        read = frame.sparkSession.read.parquet(path)
        assert {"_shard" if "shard" in frame.columns else "shard"} == set(read.columns) - set(frame.columns)
        assert sorted(map(str, read.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))


def test_cells_follow_the_order_of_names(spark):
    names = [None, "", *(f"src{i:02d}" for i in range(40)), *["src07"] * 30, "src", "srcé", "é"]
    frame = spark.createDataFrame([(n,) for n in names], "x string")
    (skip, bounds), = sharding.category_bounds(frame, ("x",)).values()
    cells = {r.x: r.c for r in frame.select("x", sharding.quantised(F.col("x"), skip, bounds).alias("c")).collect()}
    assert cells.pop(None) == 0 and min(cells.values()) >= 1 and max(cells.values()) <= 31
    ordered = [cells[n] for n in sorted(cells, key=lambda n: n.encode())]
    assert ordered == sorted(ordered) and len(set(ordered)) > 10
    same = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    (skip, bounds), = sharding.category_bounds(same, ("x",)).values()
    assert same.select(sharding.quantised(F.col("x"), skip, bounds)).distinct().count() == 2
    assert sharding.category_bounds(same.limit(0), ("x",)) == {"x": (0, [])}


def test_files_are_pruned_by_source_and_size(spark, tmp_path):
    """The least and greatest source of a file leave out most files for a source, by hash none."""
    rows = [(i, "x" * (1 + (i * 37) % 4000), "en", f"src{i % 32:02d}", 0) for i in range(3_200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = str(tmp_path / "shards")
    sharding.write_shards(frame, path)
    spans = spark.read.parquet(path).groupBy("shard").agg(F.min("source").alias("low"), F.max("source").alias("high")).collect()
    opened = [sum(s.low <= f"src{i:02d}" <= s.high for s in spans) for i in range(32)]
    assert len(spans) == 8 and sum(opened) / 32 < 5
