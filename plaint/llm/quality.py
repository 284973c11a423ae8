"""Text quality by votes of the nearest labelled documents in a latent-semantic space.

A document is a bag of terms of three kinds: its words, their character trigrams (both hashed), and
the shapes of words: runs of character classes, whether a word repeats one of the two before it, and
how many words of a block are new to it. Terms weighted by rarity are projected on the leading
singular vectors of the labelled sample. Each document's cosine products with all labelled vectors
are computed in blocks, and the nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaint.llm.batches import (
    _LOWER,
    _SPACE,
    BATCH_ROWS,
    Powers,
    Words,
    batch_rows,
    chunks,
    column,
    per_batch,
    small_batches,
)

FOLDS = 5
HELD_OUT = 0
# Labelled documents to learn from, per label: the bound of what is fitted and broadcast.
SAMPLE_PER_LABEL = 1_500
# Hashed terms of each kind.
SHAPE_TERMS, WORD_TERMS, TRIGRAM_TERMS = 1_024, 2_048, 2_048
TERMS = SHAPE_TERMS + WORD_TERMS + TRIGRAM_TERMS
# Length of the words' and of the trigrams' part of a bag; that of the shapes is about as long.
CONTENT = 1.0
DIMENSIONS = 64
NEIGHBOURS = 25
# Cosines are raised to this power, so that close neighbours outvote far ones.
SHARPNESS = 8
CUT = 0.3
BLOCK = 256
# Repetition is counted within blocks of words, so that it does not grow with the text.
BLOCK_WORDS = 64
NEUTRAL = 0.5

# Classes of bytes: letters, digits, bytes of other scripts, space; each other sign is its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[128:] = 4

# The first terms are kept for what is counted per text rather than per word.
_REPEAT, _REPEAT_2, _NEW, _LONG = 0, 1, 2, 12
_SHAPES = 24


def trigrams(content: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed term of the three bytes around each byte of a word, lower-cased; what is not
    of a word, and what lies beyond the text, counts as a space."""
    inside = _SPACE[content]
    signs = np.where(inside, _LOWER[content], 32).astype(np.uint32)
    before, after = np.full(len(signs), 32, np.uint32), np.full(len(signs), 32, np.uint32)
    before[1:], after[:-1] = signs[:-1], signs[1:]
    filled = bounds[:-1] < bounds[1:]
    before[bounds[:-1][filled]] = 32
    after[bounds[1:][filled] - 1] = 32
    middle = np.flatnonzero(inside)
    code = (before[middle] << np.uint32(16)) | (signs[middle] << np.uint32(8)) | after[middle]
    mixed = (code * np.uint32(0x9E3779B1)) >> np.uint32(8)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[middle]
    return row, (mixed % np.uint32(TRIGRAM_TERMS)).astype(np.int64)


def shares(row: np.ndarray, term: np.ndarray, rows: int, terms: int) -> np.ndarray:
    """Each row's share of each term among its terms."""
    counts = np.bincount(row * terms + term, minlength=rows * terms).reshape(rows, terms).astype(np.float32)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def bags(texts: pa.Array, powers: Powers) -> np.ndarray:
    """One row of term weights per text: square roots of the shares of its words and trigrams."""
    parts = []
    for first, end, content, bounds in chunks(texts):
        words = Words(content, bounds, powers, lower=True)
        out = np.zeros((end - first, SHAPE_TERMS), np.float32)
        content_terms = np.zeros((end - first, WORD_TERMS + TRIGRAM_TERMS), np.float32)
        if len(words.starts):
            kinds = _CLASS[content]
            turn = np.ones(len(kinds), bool)
            turn[1:] = kinds[1:] != kinds[:-1]
            turn[words.starts] = True
            runs = np.flatnonzero(turn)
            sums = powers.prefix(kinds[runs])
            shape = powers.between(sums, np.searchsorted(runs, words.starts), np.searchsorted(runs, words.ends))
            term = _SHAPES + (shape % np.uint64(SHAPE_TERMS - _SHAPES)).astype(np.int64)
            row = np.searchsorted(words.rows, np.arange(len(words.starts)), side="right") - 1
            np.add.at(out, (row, term), 1)
            hashes = words.hashes
            same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) + 1
            np.add.at(out, (row[same], _REPEAT), 1)
            same = np.flatnonzero((hashes[2:] == hashes[:-2]) & (row[2:] == row[:-2])) + 2
            np.add.at(out, (row[same], _REPEAT_2), 1)
            size = words.ends - words.starts
            np.add.at(out, (row[size > 20], _LONG), 1)
            place = np.arange(len(row)) - words.rows[row]
            block = np.cumsum(place % BLOCK_WORDS == 0) - 1
            order = np.lexsort((hashes, block))
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (block[order][1:] != block[order][:-1])
            held = np.bincount(block)
            share = np.minimum(10 * np.bincount(block[order][new]) // held, 9)
            np.add.at(out, (row[place % BLOCK_WORDS == 0], _NEW + share), held)
            out /= np.maximum(np.diff(words.rows), 1)[:, None]
            word = (hashes % np.uint64(WORD_TERMS)).astype(np.int64)
            content_terms[:, :WORD_TERMS] = shares(row, word, end - first, WORD_TERMS)
            content_terms[:, WORD_TERMS:] = shares(*trigrams(content, bounds), end - first, TRIGRAM_TERMS)
        parts.append(np.hstack([np.sqrt(out), CONTENT * np.sqrt(content_terms)]))
    return np.concatenate(parts) if parts else np.zeros((0, TERMS), np.float32)


@dataclass
class Votes:
    """What is sent to all tasks: term weights, singular vectors, labelled vectors and labels."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, rows: np.ndarray) -> np.ndarray:
        points = rows @ self.projection
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Share of the weighted votes for label 1; neutral without words or labelled vectors."""
        out = np.full(len(rows), NEUTRAL)
        nearest = min(NEIGHBOURS, len(self.labels))
        if not nearest:
            return out
        for at in range(0, len(rows), BLOCK):
            block = rows[at : at + BLOCK]
            cosines = self.place(block) @ self.vectors.T
            near = np.argpartition(cosines, -nearest, axis=1)[:, -nearest:]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            voted = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
            out[at : at + BLOCK] = np.where((total > 0) & block.any(axis=1), voted, NEUTRAL)
        return np.clip(out, 0.0, 1.0)


def fit_votes(rows: np.ndarray, labels: np.ndarray) -> Votes:
    """Rarity weights and a truncated singular value decomposition of the labelled rows."""
    if not len(rows):
        return Votes(np.zeros((TERMS, DIMENSIONS), np.float32), np.zeros((0, DIMENSIONS), np.float32), labels)
    used = (rows > 0).sum(axis=0)
    rarity = (np.log((1 + len(rows)) / (1 + used)) + 0.2).astype(np.float32)
    weighted = rows * rarity
    random = np.random.default_rng(7).standard_normal((TERMS, DIMENSIONS + 16)).astype(np.float32)
    basis = weighted @ random
    for _ in range(4):
        basis, _ = np.linalg.qr(weighted @ (weighted.T @ basis))
    _, _, right = np.linalg.svd(basis.T @ weighted, full_matrices=False)
    projection = rarity[:, None] * right[:DIMENSIONS].T
    found = Votes(projection.astype(np.float32), np.zeros((0, DIMENSIONS), np.float32), labels)
    found.vectors = found.place(rows).astype(np.float32)
    return found


def fold(doc_id: str, folds: int) -> str:
    return f"crc32(cast(cast(`{doc_id}` as string) as binary)) % {folds}"


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Bags and labels of at most SAMPLE_PER_LABEL documents a label, the same in every run."""
    learn = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    learn = learn.filter(f"{fold('doc_id', FOLDS)} != {HELD_OUT} and label in (0, 1)").dropDuplicates(["doc_id"])
    present = docs.select(F.col(doc_id).alias("doc_id"))
    learn = learn.join(present, "doc_id", "left_semi")
    chosen = None
    for value in (0, 1):
        part = learn.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    # At most 2 * SAMPLE_PER_LABEL rows of two numbers.
    rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("bag", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()

        def bag_rows(batch: pa.RecordBatch) -> dict:
            found = bags(column(batch, "text"), powers)
            return {
                "doc_id": column(batch, "doc_id"),
                "label": column(batch, "label"),
                "bag": [zlib.compress(row.astype(np.float16).tobytes(), 1) for row in found],
            }

        yield from per_batch(schema, bag_rows)(batches)

    with batch_rows(docs.sparkSession, BATCH_ROWS):
        found = rows.mapInArrow(work, "doc_id long, label int, bag binary").dropDuplicates(["doc_id"]).toArrow()
    found = found.sort_by("doc_id")
    if not found.num_rows:
        return np.zeros((0, TERMS), np.float32), np.zeros(0)
    joined = np.frombuffer(b"".join(map(zlib.decompress, found["bag"].to_pylist())), np.float16).reshape(-1, TERMS)
    return joined.astype(np.float32), found["label"].to_numpy().astype(np.float64)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, and the columns to keep beside
    them (their names differ from these). Scores are made where the rows are read: no shuffle.

    Learns from rows with a label whose fold is not held out, at most SAMPLE_PER_LABEL a label, of
    `learn_from` (default: the documents). The text is the only input of a score. Null, empty and
    wordless texts, and all texts where there are no labels, score 0.5. Null labels and labels
    other than 0 and 1 are left out; of repeated labels one counts. A null id is not held out.
    Repeated rows get equal answers. An empty table gives an empty result. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows, truth = labelled_sample(docs if learn_from is None else learn_from, labels, doc_id, text, label)
    votes = fit_votes(rows, truth)
    # Plain arrays: at most 2 * SAMPLE_PER_LABEL vectors and one matrix.
    sent = spark.sparkContext.broadcast((votes.projection, votes.vectors, votes.labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, votes = Powers(), Votes(*sent.value)
        for batch in batches:
            scores = votes.score(bags(batch.column(0), powers))
            # The text itself goes on only if it is kept.
            arrays = [*batch.columns[1:], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[1:], "score"])

    small_batches(spark)
    given = docs.select(F.col(text).alias("_text"), F.col(doc_id).cast("bigint").alias("_id"), *keep)
    added = T.StructType([*given.schema.fields[1:], T.StructField("score", T.DoubleType())])
    shown = [F.col(name) for name in keep if name != "doc_id"]
    return given.mapInArrow(work, added).select(
        F.col("_id").alias("doc_id"),
        *shown,
        F.coalesce(F.expr(f"{fold('_id', FOLDS)} = {HELD_OUT}"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
