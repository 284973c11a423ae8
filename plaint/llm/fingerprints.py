"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases level by level. Runs of one symbol are joined; deterministic coin
tossing against the left neighbour shrinks the names to a few labels; phrases start at the local
maxima of the labels. A cut depends on a few neighbours only, so equal substrings are cut alike but
for their edges, wherever they stand. A phrase is named by its content, and the smallest names of
all phrases are the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.llm.batches import Powers, chunks, column, mix, small_batches

# Names of phrases from this level on are features; a phrase there has about ten bytes or more.
FIRST_LEVEL = 2
LEVELS = 16
NAMES = 64
TOSSES = 4
# Runs of documents by id that are dealt to tasks, per shuffle partition.
RUNS_PER_PARTITION = 4

_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_DEALT = pa.schema(
    [
        ("run", pa.int32()),
        ("guest", pa.int32()),
        ("key", pa.int64()),
        ("tie", pa.int64()),
        ("doc_id", pa.int64()),
        ("packed", pa.binary()),
    ]
)
DEALT_DDL = "run int, guest int, key long, tie long, doc_id long, packed binary"
_BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64))


def toss(symbols: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Labels below eight that differ between neighbours: twice the place of the lowest bit in
    which a symbol differs from the one to its left, plus that bit, several times over."""
    labels = symbols
    for _ in range(TOSSES):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[edges] = labels[edges] ^ 1
        differ = labels ^ left
        lowest = differ & (~differ + labels.dtype.type(1))
        place = np.bitwise_count(lowest - labels.dtype.type(1))
        bit = (labels & lowest) != 0
        labels = (2 * place + bit).astype(np.uint8)
    return labels


def parse_level(names: np.ndarray, symbols: np.ndarray, rows: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases one level up, and the rows' offsets among them."""
    edges = rows[:-1][rows[:-1] < rows[1:]]
    change = np.ones(len(names), bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[edges] = True
    starts = np.flatnonzero(change)
    length = np.diff(np.append(starts, len(names)))
    names, symbols = names[starts], symbols[starts]
    long = length > 1
    names[long] = mix(names[long] + length[long].astype(np.uint64))
    rows = np.searchsorted(starts, rows)
    edges = rows[:-1][rows[:-1] < rows[1:]]
    labels = toss(symbols, edges)
    rises = np.ones(len(labels), bool)
    rises[1:] = labels[1:] > labels[:-1]
    falls = np.ones(len(labels), bool)
    falls[:-1] = labels[:-1] > labels[1:]
    falls[edges[1:] - 1] = True
    cut = rises & falls
    cut[edges] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(names))
    phrases = powers.between(powers.prefix(names), starts, ends)
    return phrases, np.searchsorted(starts, rows)


def fingerprints(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """The smallest phrase names of each text, in order; none for an empty text."""
    found: list[np.ndarray] = []
    for first, end, content, rows in chunks(pa.array(texts, pa.large_binary())):
        parts: list[list[np.ndarray]] = [[] for _ in range(end - first)]
        names, symbols = _BYTE_NAMES[content], content
        done = np.diff(rows) == 0
        for level in range(1, LEVELS + 1):
            if done.all():
                break
            names, rows = parse_level(names, symbols, rows, powers)
            symbols = names
            sizes = np.diff(rows)
            # The name of a whole text is always a feature, so that short texts have one.
            for i in np.flatnonzero(~done & ((sizes == 1) | (level >= FIRST_LEVEL))):
                parts[i].append(names[rows[i] : rows[i + 1]])
            done |= sizes == 1
            if done.all():
                break
        for own in parts:
            joined = np.unique(np.concatenate(own) >> np.uint64(32)) if own else np.zeros(0, np.uint64)
            found.append(joined[:NAMES])
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common names among the smallest names of both; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:NAMES]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, union, assume_unique=True).sum() / len(union))


def spelled(names: np.ndarray) -> str:
    return "".join(f"{name:08x}" for name in names.tolist())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points, rounded down, replaced by the first of the next text."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


def _dealt(bounds: np.ndarray):
    """Deal documents to runs of ids. The first document of a run also goes to the run before, as
    the guest that the run's last document needs; that of the first run to the last run."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            keys = column(batch, "key").to_numpy()
            texts = [pack.compress((t.as_py() or "").encode()) for t in column(batch, "text")]
            run = np.searchsorted(bounds, keys, side="right") - 1
            first = bounds[run] == keys
            guest = np.flatnonzero(first)
            take = np.concatenate([np.arange(len(keys)), guest])
            runs = np.concatenate([run, (run[guest] - 1) % len(bounds)])
            flags = np.concatenate([np.zeros(len(keys), np.int32), np.ones(len(guest), np.int32)])
            yield pa.RecordBatch.from_pydict(
                {
                    "run": runs.astype(np.int32),
                    "guest": flags,
                    "key": keys[take],
                    "tie": column(batch, "tie").take(pa.array(take)),
                    "doc_id": column(batch, "doc_id").take(pa.array(take)),
                    "packed": [texts[i] for i in take],
                },
                schema=_DEALT,
            )

    return deal


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a run in order of id: each with the one that follows."""
    powers, unpack = Powers(), zstandard.ZstdDecompressor()
    waiting = None  # run, doc_id, text, fingerprint
    for batch in batches:
        runs, guests = column(batch, "run").to_pylist(), column(batch, "guest").to_pylist()
        ids = column(batch, "doc_id").to_pylist()
        raw = [unpack.decompress(p) for p in column(batch, "packed").to_pylist()]
        prints = fingerprints(raw, powers)
        pairs = []
        for i, content in enumerate(raw):
            row = (runs[i], ids[i], content.decode(), prints[i])
            if waiting is not None and waiting[0] == row[0]:
                pairs.append((waiting, row))
            waiting = None if guests[i] else row
        if not pairs:
            continue
        changed = [edited(a[2], b[2]) for a, b in pairs]
        other = fingerprints([t.encode() for t in changed], powers)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": [a[1] for a, _ in pairs],
                "n_chars": [len(a[2]) for a, _ in pairs],
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                "fingerprint": [spelled(a[3]) for a, _ in pairs],
                "edited_fingerprint": [spelled(e) for e in other],
                "near_edited": [likeness(a[3], e) for (a, _), e in zip(pairs, other)],
                "near_next": [likeness(a[3], b[3]) for a, b in pairs],
            },
            schema=_OUT,
        )


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its fingerprint, that of the edited text, and how alike they are.

    Null texts are empty; an empty text has an empty fingerprint, like another empty one only. The
    next document is the next by id; rows without an id come first, rows with one id are ordered by
    their text's hash, and equal rows follow each other. A single row follows itself. An empty
    table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64(text).alias("tie"),
        F.col(text).alias("text"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = RUNS_PER_PARTITION * parts
    # The bounds are ids that occur, so each is the first id of its run. One number per run.
    shares = F.percentile_approx("key", [i / count for i in range(1, count)], 20 * count)
    cut = rows.agg(F.min("key").alias("first"), shares.alias("bounds")).collect()[0]
    if cut["first"] is None:
        return docs.limit(0).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in OUT_DDL.split(", ")])
    bounds = np.unique(np.array([cut["first"], *cut["bounds"]], np.int64))
    small_batches(spark)
    dealt = rows.mapInArrow(_dealt(bounds), DEALT_DDL)
    dealt = dealt.repartition("run").sortWithinPartitions("run", "guest", "key", "tie")
    return dealt.mapInArrow(_compare, OUT_DDL)
