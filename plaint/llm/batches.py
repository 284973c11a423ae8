"""Helpers shared by the operators of this folder: Arrow buffers, word hashes, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plaint.session import scratch_dir

# Rows of one Arrow batch: a batch of whole documents has to fit beside a Python worker's arrays.
BATCH_ROWS = 128
# Text bytes that the array code works on at a time; a longer document is worked on alone.
CHUNK_BYTES = 1 << 18
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_NGRAM = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what runs within; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of few rows, since one row is a whole document."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: what follows survives a lost executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    # The table is whole once it is written, so the shuffle files behind it can go.
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, size: int) -> np.ndarray:
    """base ** i modulo 2**64 for i below size, by doubling."""
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, 1 << 64))
        take = min(done, size - done)
        out[done : done + take] = out[:take] * step
        done += take
    return out


class Powers:
    """Powers of the hash base and of its inverse, made longer when a longer text comes."""

    def __init__(self) -> None:
        self.up = _powers(_MULTIPLIER, CHUNK_BYTES + 1)
        self.down = _powers(_INVERSE, CHUNK_BYTES + 1)

    def reach(self, size: int) -> None:
        if size > len(self.up):
            self.up = _powers(_MULTIPLIER, size)
            self.down = _powers(_INVERSE, size)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """Hash sums of all prefixes of the symbols, one longer than these."""
        self.reach(len(symbols) + 1)
        sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * self.up[: len(symbols)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the symbols from each start to each end: equal runs get equal hashes anywhere."""
        raw = (sums[ends] - sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_NGRAM))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and row offsets of runs of rows of about CHUNK_BYTES."""
    content, bounds = text_buffer(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, content[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


_SPACE = np.ones(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """Words of a run of texts: where they start and end, their hashes, and each row's share."""

    def __init__(self, content: np.ndarray, bounds: np.ndarray, powers: Powers, lower: bool) -> None:
        inside = _SPACE[content]
        edges = bounds[:-1][bounds[:-1] < bounds[1:]]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[edges[1:] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        sums = powers.prefix(_LOWER[content] if lower else content)
        self.hashes = powers.between(sums, self.starts, self.ends)
        self.rows = np.searchsorted(self.starts, bounds)


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of `size` words that starts at each word."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for j in range(size):
        out += hashes[j : j + count] * np.uint64(pow(_NGRAM, j, 1 << 64))
    return mix(out + np.uint64(size))


def per_batch(schema: pa.Schema, work: Callable[[pa.RecordBatch], dict]) -> Callable:
    """A function for mapInArrow that makes one batch of columns from each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(work(batch), schema=schema)

    return run


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
