"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Candidates are written in the order of (label, Hilbert index) and cut into blocks of one label; a
block keeps the minimum and maximum of each dimension. Interval arithmetic over these bounds every
score of an anchor in a block, so an anchor reads only the blocks that may hold a row it returns:

1. positives: rows of its own label at least as good as its fifth best in its own block;
2. negatives: rows of other labels whose scores may fall in one of its windows and, where a few
   blocks read before have filled a window, may still be among its best.

Anchors go in groups of one label and similar places on the curve. A group and some of the blocks it
reads meet in one task, where scores are exact integer products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaint.llm.batches import batch_rows, column, staged

BLOCK_ROWS = 512
GROUP_ROWS = 512
# Dimensions of the curve and bits of each.
CURVE_DIMS = 8
CURVE_BITS = 7
# Zone maps that one task compares with a group, and blocks that one task reads for a group.
ZONES_AT_ONCE = 1_024
BLOCKS_AT_ONCE = 32
# Blocks that a group reads first, to know how good its negatives are at least.
SEED_BLOCKS = 3
# Components are held within this bound, so that products of 2**14 of them fit 64 bits.
LARGEST = 1 << 24
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("label", pa.string()),
        ("curve", pa.int64()),
        ("vec_id", pa.int64()),
        ("ids", pa.binary()),
        ("vectors", pa.binary()),
        ("zone", pa.binary()),
        ("best", pa.int64()),
    ]
)
BLOCK_DDL = "block long, label string, curve long, vec_id long, ids binary, vectors binary, zone binary, best long"
_GROUP = pa.schema(
    [("group", pa.int64()), ("label", pa.string()), ("ids", pa.binary()), ("vectors", pa.binary()), ("windows", pa.binary())]
)
GROUP_DDL = "group long, label string, ids binary, vectors binary, windows binary"
_NEEDED = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("reach", pa.float64()), ("needed", pa.binary())])
NEEDED_DDL = "group long, block long, reach double, needed binary"
_SCORED = pa.schema(
    [("group", pa.int64()), ("place", pa.int32()), ("window", pa.int32()), ("found_id", pa.int64()), ("score", pa.int64())]
)
SCORED_DDL = "group long, place int, window int, found_id long, score long"
_PLACED = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("label", pa.string()),
        ("vector", pa.list_(pa.int64())),
        ("anchor", pa.bool_()),
        ("curve", pa.int64()),
    ]
)
PLACED_DDL = "vec_id long, label string, vector array<long>, anchor boolean, curve long"
_NAMED = pa.schema([("group", pa.int64()), ("place", pa.int32()), ("anchor_id", pa.int64())])
NAMED_DDL = "group long, place int, anchor_id long"
_SPREAD = pa.schema(
    [("dim", pa.int32())] + [(n, pa.float64()) for n in ("n", "total", "squares", "low", "high")]
)
SPREAD_DDL = "dim int, n double, total double, squares double, low double, high double"


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are continued by zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def packed(vectors: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold them, after one byte that says how many."""
    bound = int(np.abs(vectors).max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32) if bound <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + vectors.astype(kind).tobytes()


def unpacked(blob: bytes, width: int) -> np.ndarray:
    values = np.frombuffer(blob, np.dtype(f"i{blob[0]}"), offset=1).astype(np.int64)
    return values.reshape(-1, width) if width else values.reshape(-1, 0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of two matrices: in doubles where these hold them all."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score of each anchor over all vectors between two corners."""
    above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return product(above, low) + product(below, high), product(above, high) + product(below, low)


def hilbert_indices(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (the public transform to the transposed
    index, over all rows at once)."""
    axes = cells.astype(np.int64).T.copy()
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        low = bit - 1
        for axis in range(len(axes)):
            inverted = (axes[axis] & bit) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axes[axis]) & low)
            axes[0] ^= np.where(inverted, low, swap)
            axes[axis] ^= swap if axis else 0
    for axis in range(1, len(axes)):
        axes[axis] ^= axes[axis - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(axes[-1] & bit, bit - 1, 0)
    axes ^= turn
    index = np.zeros(axes.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | ((axis >> b) & 1)
    return index


def first_in_windows(scores: np.ndarray, ids: np.ndarray, windows: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The first `most` columns of each row and window (low, high): anchor, window, id, score.

    Higher scores come first, ties by smaller id."""
    order = np.argsort(ids, kind="stable")
    scores, ids, count = scores[:, order], ids[order], len(ids)
    value = scores
    if int(np.abs(scores).max(initial=0)) > 1 << 52:
        value = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    keys = value * count + np.arange(count)[::-1]
    out: list[tuple[np.ndarray, ...]] = []
    for w in range(windows.shape[1]):
        inside = (scores >= windows[:, w, :1]) & (scores <= windows[:, w, 1:])
        masked = np.where(inside, keys, LOWEST)
        if count > most:
            chosen = np.argpartition(masked, count - most, axis=1)[:, count - most :]
        else:
            chosen = np.broadcast_to(np.arange(count), masked.shape)
        row, at = np.nonzero(np.take_along_axis(inside, chosen, 1))
        picked = chosen[row, at]
        out.append((row, np.full(len(row), w), ids[picked], scores[row, picked]))
    return tuple(np.concatenate(c) for c in zip(*out))


def best_of(found: tuple[np.ndarray, ...], most: int) -> tuple[np.ndarray, ...]:
    """The first `most` of each anchor and window."""
    row, window, ids, scores = found
    order = np.lexsort((ids, -scores, window, row))
    row, window = row[order], window[order]
    new = np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1]))[: len(row)]
    start = np.flatnonzero(new)[np.cumsum(new) - 1] if len(row) else row
    keep = np.arange(len(row)) - start < most
    return row[keep], window[keep], ids[order][keep], scores[order][keep]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: np.ndarray = np.zeros((5, 0))
    for batch in batches:
        vectors = column(batch, "vector")
        width = max((len(v) for v in vectors), default=0)
        values = matrix(vectors, width).astype(np.float64)
        own = np.stack([np.full(width, len(values)), values.sum(0), (values**2).sum(0), values.min(0), values.max(0)])
        if width > sums.shape[1]:
            sums = np.pad(sums, ((0, 0), (0, width - sums.shape[1])))
        sums[:3, :width] += own[:3]
        sums[3, :width] = np.minimum(sums[3, :width], own[3])
        sums[4, :width] = np.maximum(sums[4, :width], own[4])
    if sums.shape[1]:
        yield pa.RecordBatch.from_arrays([pa.array(range(sums.shape[1]), pa.int32()), *map(pa.array, sums)], schema=_SPREAD)


def _curve(dims: list[int], low: np.ndarray, high: np.ndarray, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(column(batch, "vector"), width)[:, dims]
            cells = (values - low) / np.maximum(high - low, 1) * ((1 << CURVE_BITS) - 1)
            index = hilbert_indices(cells.astype(np.int64), CURVE_BITS) if dims else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(index, pa.int64())], schema=_PLACED)

    return run


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Consecutive rows of one label, at most `most` at a time."""
    held: list[pa.RecordBatch] = []
    label, count = None, 0
    for batch in batches:
        labels, first = column(batch, "label").to_pylist(), 0
        while first < len(labels):
            if held and (labels[first] != label or count == most):
                yield pa.Table.from_batches(held)
                held, count = [], 0
            label, end = labels[first], first
            while end < len(labels) and labels[end] == label and count + end - first < most:
                end += 1
            held.append(batch.slice(first, end - first))
            count, first = count + end - first, end
    if held:
        yield pa.Table.from_batches(held)


def _first_number() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 32


def _blocks(width: int, positives: int):
    """Blocks of sorted candidates, and each anchor with how good its positives are at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(_runs(batches, BLOCK_ROWS), _first_number()):
            ids, label = table["vec_id"].to_numpy(), table["label"][0].as_py()
            vectors = matrix(table["vector"], width)
            zone = packed(np.stack([vectors.min(0), vectors.max(0)]))
            rows = [(number, label, None, None, ids.tobytes(), packed(vectors), zone, None)]
            at = np.flatnonzero(table["anchor"].to_numpy(zero_copy_only=False))
            own = product(vectors[at], vectors)
            best = np.where(ids[at][:, None] == ids, LOWEST, own)
            fifth = np.sort(best, axis=1)[:, -positives] if len(ids) >= positives else np.full(len(at), LOWEST)
            curve = table["curve"].to_numpy()
            for i, row in enumerate(at.tolist()):
                rows.append((None, label, int(curve[row]), int(ids[row]), None, packed(vectors[row]), None, int(fifth[i])))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors in groups; the window of a positive begins at what the anchor's own block has."""
    for number, table in enumerate(_runs(batches, GROUP_ROWS), _first_number()):
        at_least = np.maximum(table["best"].to_numpy(), LOWEST + 1)
        windows = np.stack([at_least, np.full(table.num_rows, HIGHEST)], axis=1)
        blobs = table["vectors"].to_pylist()
        vectors = np.stack([np.frombuffer(b, np.dtype(f"i{b[0]}"), offset=1).astype(np.int64) for b in blobs])
        row = [number, table["label"][0].as_py(), table["vec_id"].to_numpy().tobytes(), packed(vectors), windows.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _GROUP)], schema=_GROUP)


def _choose(width: int, own_label: bool, most: int | None = None):
    """Which zones each anchor of a group must read, by interval arithmetic. Given `most`, so many
    blocks of the highest bounds for the whole group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            names = ("group", "label", "vectors", "windows", "zones")
            for group, label, vectors, windows, zones in zip(*(column(batch, n).to_pylist() for n in names)):
                zones = [z for z in zones if (z["label"] == label) == own_label]
                if not zones:
                    continue
                anchors = unpacked(vectors, width)
                window = np.frombuffer(windows, np.int64).reshape(len(anchors), -1, 2)
                corners = np.stack([unpacked(z["zone"], width) for z in zones])
                low, high = bounds(anchors, corners[:, 0], corners[:, 1])
                needed = np.zeros(low.shape, bool)
                for w in range(window.shape[1]):
                    needed |= (high >= window[:, w, :1]) & (low <= window[:, w, 1:]) & (window[:, w, :1] <= window[:, w, 1:])
                reach = np.where(needed, high, 0).sum(0, dtype=np.float64)
                wanted = np.flatnonzero(needed.any(0))
                if most is not None:
                    wanted = wanted[np.argsort(-reach[wanted], kind="stable")][:most]
                for z in wanted.tolist():
                    out.append((group, zones[z]["block"], float(reach[z]), np.packbits(needed[:, z]).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _NEEDED)], schema=_NEEDED)

    return run


def _score(width: int, most: int, own_label: bool):
    """The best rows in each window of a group's anchors, over some of the blocks that they need."""

    def run(blocks: pa.Table, groups: pa.Table) -> pa.Table:
        if not blocks.num_rows or not groups.num_rows:
            return _SCORED.empty_table()
        anchors = unpacked(groups["vectors"][0].as_py(), width)
        anchor_ids = np.frombuffer(groups["ids"][0].as_py(), np.int64)
        windows = np.frombuffer(groups["windows"][0].as_py(), np.int64).reshape(len(anchors), -1, 2)
        found = []
        for ids, vectors, needed in zip(*(blocks[n].to_pylist() for n in ("block_ids", "block_vectors", "needed"))):
            at = np.flatnonzero(np.unpackbits(np.frombuffer(needed, np.uint8), count=len(anchors)))
            own = np.frombuffer(ids, np.int64)
            scores = product(anchors[at], unpacked(vectors, width))
            if own_label:
                # Below every window: no row is a positive of itself or of another one with its id.
                scores[anchor_ids[at][:, None] == own] = LOWEST
            row, *rest = first_in_windows(scores, own, windows[at], most)
            found.append((at[row], *rest))
        row, window, ids, scores = best_of(tuple(np.concatenate(c) for c in zip(*found)), most)
        group = np.full(len(row), groups["group"][0].as_py())
        return pa.table([pa.array(c, f.type) for c, f in zip((group, row, window, ids, scores), _SCORED)], schema=_SCORED)

    return run


def _windows(low: int, high: int):
    """The window of each positive, and how good its negatives are at least by the blocks read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            names = ("group", "label", "ids", "vectors", "found", "floors")
            for group, label, ids, vectors, found, floors in zip(*(column(batch, n).to_pylist() for n in names)):
                anchors = len(np.frombuffer(ids, np.int64))
                most = max((f["window"] for f in found or ()), default=0) + 1
                windows = np.tile(np.array([1, 0], np.int64), (anchors, most, 1))
                for f in found or ():
                    own = windows[f["place"], f["window"]]
                    own[0], own[1] = -((-low * f["score"]) // 100), high * f["score"] // 100
                for f in floors or ():
                    windows[f["place"], f["window"], 0] = max(windows[f["place"], f["window"], 0], f["score"])
                rows.append((group, label, ids, vectors, windows.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _GROUP)], schema=_GROUP)

    return run


class Miner:
    """The written blocks and groups, and the steps over them."""

    def __init__(self, rows: DataFrame, positives: int) -> None:
        sums = [F.sum(n).alias(n) for n in ("n", "total", "squares")]
        spread = rows.mapInArrow(_spread, SPREAD_DDL).groupBy("dim")
        # One row per dimension.
        dims = sorted(spread.agg(*sums, F.min("low").alias("low"), F.max("high").alias("high")).collect())
        self.width = len(dims)
        widest = sorted(dims, key=lambda r: (r.total**2 / r.n - r.squares, r.dim))[:CURVE_DIMS]
        low, high = np.array([r.low for r in widest]), np.array([r.high for r in widest])
        placed = rows.mapInArrow(_curve([r.dim for r in widest], low, high, self.width), PLACED_DDL)
        order = ["label", "curve", "vec_id"]
        ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
        written = staged(ordered.mapInArrow(_blocks(self.width, positives), BLOCK_DDL), "blocks")
        self.blocks = written.filter("block is not null")
        anchors = written.filter("block is null").select("label", "curve", "vec_id", "vectors", "best")
        anchors = anchors.repartitionByRange(*order).sortWithinPartitions(*order)
        self.groups = staged(anchors.mapInArrow(_groups, GROUP_DDL), "groups")
        count = self.blocks.count()
        self.packs = max(1, -(-count // ZONES_AT_ONCE))
        self.salts = max(1, -(-count // BLOCKS_AT_ONCE))
        pack = F.pmod(F.xxhash64("block"), F.lit(self.packs)).alias("pack")
        zones = self.blocks.select("label", "block", "zone", pack).groupBy("pack")
        self.zones = staged(zones.agg(F.collect_list(F.struct("label", "block", "zone")).alias("zones")), "zones")

    def choose(self, groups: DataFrame, own_label: bool, most: int | None = None) -> DataFrame:
        """The blocks that groups need. Given `most`, only so many, of the first pack of zones."""
        packs = F.sequence(F.lit(0), F.lit(0 if most else self.packs - 1)).cast("array<bigint>")
        asked = groups.withColumn("pack", F.explode(packs))
        both = asked.join(self.zones, "pack").select("group", "label", "vectors", "windows", "zones")
        return both.mapInArrow(_choose(self.width, own_label, most), NEEDED_DDL)

    def read(self, groups: DataFrame, needed: DataFrame, most: int, own_label: bool) -> DataFrame:
        """The first rows in each window of each anchor, over the blocks that are needed."""
        blocks = self.blocks.selectExpr("block", "ids as block_ids", "vectors as block_vectors")
        salt = F.pmod(F.xxhash64("block"), F.lit(self.salts))
        meeting = needed.select(F.col("group").alias("owner"), "block", "needed").join(blocks, "block")
        salts = F.sequence(F.lit(0), F.lit(self.salts - 1)).cast("array<bigint>")
        dealt = groups.withColumn("salt", F.explode(salts))
        pairs = meeting.withColumn("salt", salt).groupBy("owner", "salt").cogroup(dealt.groupBy("group", "salt"))
        scored = pairs.applyInArrow(_score(self.width, most, own_label), SCORED_DDL)
        best = Window.partitionBy("group", "place", "window").orderBy(F.desc("score"), "found_id")
        return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)


def by_group(found: DataFrame, name: str) -> DataFrame:
    return found.groupBy("group").agg(F.collect_list(F.struct("place", "window", "score")).alias(name))


def hard_negatives(
    vectors: DataFrame,
    anchor: Column | str,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """The first negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components become floor(scale * x). A score is an integer product; higher ones come first, ties
    by smaller id. Positives of an anchor (a row for which `anchor` holds) are the first rows of its
    label; negatives are the first rows of other labels whose score lies between `low` and `high`
    percent of the positive's. There is no cap on blocks or rows: what is not read cannot be among them.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; nor does
    a null `anchor` make one. Vectors of fewer components are continued by zeros; scaled components
    are held within 2**24. Repeated rows are rows of their own, but rows with an anchor's id are not
    its positives; an anchor that is there twice is mined twice. An empty table, a table without
    anchors, or anchors without another row of their label give no row. Other columns are ignored.
    """
    component = F.col(f"_v.`{vector}`")
    real = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bound = F.lit(float(LARGEST))
    scaled = F.transform(
        component, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -bound), bound)).cast("bigint")
    )
    chosen = F.expr(anchor) if isinstance(anchor, str) else anchor
    rows = vectors.withColumn("_anchor", F.coalesce(chosen, F.lit(False))).alias("_v")
    rows = rows.filter(F.col(f"_v.`{vec_id}`").isNotNull() & F.col(f"_v.`{label}`").isNotNull() & component.isNotNull() & real)
    rows = rows.select(
        F.col(f"_v.`{vec_id}`").cast("bigint").alias("vec_id"),
        F.col(f"_v.`{label}`").cast("string").alias("label"),
        scaled.alias("vector"),
        F.col("_v._anchor").alias("anchor"),
    )
    with batch_rows(vectors.sparkSession, 64):
        return _mined(rows, positives, negatives, low, high)


def _mined(rows: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    miner = Miner(rows, positives)
    groups = miner.groups
    found = staged(miner.read(groups, miner.choose(groups, True), positives, True), "positives")
    found = found.withColumn("window", F.col("rank") - 1).select("group", "place", "window", "found_id", "score")

    none = F.lit(None).cast("array<struct<place:int,window:int,score:bigint>>")
    beside = groups.drop("windows").join(by_group(found, "found"), "group")
    first = staged(beside.withColumn("floors", none).mapInArrow(_windows(low, high), GROUP_DDL), "windows")
    floors = miner.read(first, miner.choose(first, False, SEED_BLOCKS), negatives, False)
    floors = by_group(floors.filter(F.col("rank") == negatives), "floors")
    bounded = beside.join(floors, "group", "left").mapInArrow(_windows(low, high), GROUP_DDL)
    bounded = staged(bounded, "windows")
    mined = miner.read(bounded, miner.choose(bounded, False), negatives, False)

    names = groups.select("group", "ids").mapInArrow(_names, NAMED_DDL)
    of_positive = found.selectExpr("group", "place", "window", "found_id as positive_id", "score as positive_score")
    named = mined.selectExpr("group", "place", "window", "rank", "found_id as negative_id", "score as negative_score")
    named = named.join(of_positive, ["group", "place", "window"]).join(names, ["group", "place"])
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return staged(named.select(*columns), "negatives")


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group, blob in zip(column(batch, "group").to_pylist(), column(batch, "ids").to_pylist()):
            ids = np.frombuffer(blob, np.int64)
            columns = [np.full(len(ids), group), np.arange(len(ids), dtype=np.int32), ids]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_NAMED)
