from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from plaint.llm import negatives
from plaint.llm.negatives import (
    bounds,
    first_in_windows,
    hard_negatives,
    hilbert_indices,
    matrix,
    packed,
    product,
    unpacked,
)

DDL = "vec_id long, label int, embedding array<float>, place string, `group` int, score string, block int"


def frame(spark, rows, parts=3):
    full = [(i, label, v, "x", 7, "y", 9) for i, label, v in rows]
    return spark.createDataFrame(full, DDL).repartition(parts)


def brute(rows, every, most_positives=5, most=10):
    """Rows by the contract, one pair at a time, with Python's integers."""
    real = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            real.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, label, v in real:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, own) for j, own, w in real]
        ordered = sorted(scored, key=lambda s: s[:2])
        for p, positive, _ in [s for s in ordered if s[2] == label and s[1] != i][:most_positives]:
            window = [s for s in ordered if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:most]
            out += [(i, positive, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(window)]
    return sorted(out)


def clustered(seed, count, width=6, spread=0.05, labels=4):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(labels * 3, width))
    rows = []
    for i in range(count):
        v = centers[draw.integers(len(centers))] + spread * draw.normal(size=width)
        rows.append((i, int(draw.integers(labels)), [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)]))
    return rows


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_ROWS", 7), ("GROUP_ROWS", 5), ("ZONES_AT_ONCE", 4), ("BLOCKS_AT_ONCE", 3)):
        monkeypatch.setattr(negatives, name, value)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, small_blocks, seed):
    rows = clustered(seed, 260)
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), "vec_id % 4 = 0").collect()))
    assert found == brute(rows, 4) and len(found) > 500


def test_one_vector_in_most_rows(spark, small_blocks):
    """Ties by the hundred, more than a block holds."""
    rows = [(i, i % 3, [0.6, 0.8]) for i in range(120)] + [(i, i % 2, [0.5, 0.1 * (i % 9)]) for i in range(120, 150)]
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), "vec_id % 10 = 0").collect()))
    assert found == brute(rows, 10) and found


def test_odd_rows(spark):
    nan, infinite = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [0.5, 0.5]), (10, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]),
        (20, 1, None), (30, 1, [nan, 1.0]), (40, 2, [infinite, 0.0]), (50, 1, [None, 1.0]), (60, 1, []),
        (1, 1, [0.9, 0.5]), (2, 2, [0.4, 0.3]), (2, 2, [0.4, 0.3]), (3, 3, [0.5]), (4, 3, [0.2, 0.2, 0.9]),
        (5, 1, [-1.0, -1.0]), (70, 9, [0.3, 0.3]), (6, 2, [1e6, 0.0]), (7, 1, [1e6, 0.1]),
    ]
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), "vec_id % 10 = 0", low=0, high=100).collect()))
    bounded = [(i, k, None if v is None else [None if x is None else x if not np.isfinite(x) else min(x, 2.0**16) for x in v]) for i, k, v in rows]
    wide = [(i, k, None if v is None else v + [0.0] * (3 - len(v))) for i, k, v in bounded]
    assert found == brute_between(wide, 10, 0, 100) and found
    assert hard_negatives(frame(spark, []), "vec_id % 10 = 0").collect() == []
    assert hard_negatives(frame(spark, rows), "vec_id < 0").collect() == []
    assert hard_negatives(frame(spark, [(0, 1, [1.0])]), "true").collect() == []


def brute_between(rows, every, low, high):
    real = [(i, k, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, k, v in rows if None not in (i, k, v) and None not in v and np.isfinite(v).all()]
    out = []
    for i, label, v in real:
        if i % every:
            continue
        ordered = sorted(((-sum(x * y for x, y in zip(v, w)), j, own) for j, own, w in real), key=lambda s: s[:2])
        for p, positive, _ in [s for s in ordered if s[2] == label and s[1] != i][:5]:
            window = [s for s in ordered if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:10]
            out += [(i, positive, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(window)]
    return sorted(out)


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """In clustered data most blocks cannot hold a positive, and the answers stay the same."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    seen = []
    choose = negatives.Miner.choose

    def counted(self, groups, own_label, most=None):
        needed = choose(self, groups, own_label, most)
        if own_label:
            pairs = needed.select("needed").collect()
            read = sum(int(np.unpackbits(np.frombuffer(r.needed, np.uint8)).sum()) for r in pairs)
            anchors = sum(len(r.ids) // 8 for r in groups.collect())
            seen.append(read / (anchors * self.blocks.count()))
        return needed

    monkeypatch.setattr(negatives.Miner, "choose", counted)
    rows = clustered(3, 1_500, spread=0.01, labels=3)
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), "vec_id % 50 = 0").collect()))
    assert found == brute(rows, 50) and seen[0] < 0.15


def test_session_setting_comes_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "777")
    hard_negatives(frame(spark, clustered(4, 40)), "vec_id % 10 = 0")
    assert spark.conf.get(name) == "777"
    spark.conf.set(name, before)


def test_bounds_hold_every_score():
    draw = np.random.default_rng(5)
    rows, anchors = draw.integers(-300, 300, (200, 9)), draw.integers(-300, 300, (30, 9))
    low, high = bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = product(anchors, rows)
    assert (scores == anchors @ rows.T).all()
    assert (low <= scores).all() and (scores <= high).all()
    big = np.array([[1 << 24, -(1 << 24)]])
    assert product(big, big).tolist() == [[1 << 49]]


def test_hilbert_neighbours_and_packing():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    index = hilbert_indices(cells, 3)
    assert sorted(index.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()
    for values in ([[1, -2]], [[300, 5]], [[1 << 20, -7]]):
        assert unpacked(packed(np.array(values)), 2).tolist() == values
    assert matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int64())), 2).tolist() == [[1, 2], [0, 0], [3, 0]]


def test_first_in_windows_with_ties():
    scores, ids = np.array([[5, 5, 5, 4, 9]]), np.array([30, 10, 20, 1, 2])
    windows = np.array([[[4, 5], [6, 5]]])
    row, window, found, score = first_in_windows(scores, ids, windows, 2)
    assert sorted(zip(window.tolist(), found.tolist(), score.tolist())) == [(0, 10, 5), (0, 20, 5)]
