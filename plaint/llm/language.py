"""Language of a text by a small convolutional network over bytes, written and trained in numpy.

Filters of three widths slide over one-hot byte classes of fixed windows; the largest response of
each filter in the window goes through a softmax. All windows of a text are scored, and their log
probabilities are averaged by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaint.llm.batches import chunks, column, per_batch, small_batches
from plaint.llm.quality import fold

FOLDS = 3
HELD_OUT = 1
WINDOW_BYTES = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
CLASSES = 80
# The sample to learn from: documents, and windows of each. Bounds of what the driver holds.
SAMPLE_DOCS = 2_400
SAMPLE_WINDOWS = 3
EPOCHS = 8
BATCH = 64
RATE = 0.01
NO_LANGUAGE = "und"
# Windows that are scored at a time.
BLOCK = 128

_LABELLED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _byte_classes() -> np.ndarray:
    """26 letters without case, a digit, a space, a sign, and 51 classes of other bytes."""
    table = np.full(256, 28, np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i
    table[ord("0") : ord("9") + 1] = 26
    table[[9, 10, 11, 12, 13, 32]] = 27
    table[128:] = 29 + np.arange(128) % 51
    return table


CLASS_OF = _byte_classes()
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[128:] = True


def windows_of(content: np.ndarray) -> np.ndarray:
    """All fixed-length windows of the classes of a text; the last one is filled up with spaces."""
    count = max(1, -(-len(content) // WINDOW_BYTES))
    out = np.full(count * WINDOW_BYTES, CLASS_OF[32], np.uint8)
    out[: len(content)] = CLASS_OF[content]
    return out.reshape(count, WINDOW_BYTES)


@dataclass
class Network:
    languages: list[str]
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    output: np.ndarray
    output_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Largest rectified response of each filter, and where it stands."""
        pooled, places = [], {}
        for width, table in self.filters.items():
            span = WINDOW_BYTES - width + 1
            total = self.bias[width] + table[0][windows[:, :span]]
            for j in range(1, width):
                total += table[j][windows[:, j : j + span]]
            places[width] = total.argmax(axis=1)
            pooled.append(np.maximum(np.take_along_axis(total, places[width][:, None], axis=1)[:, 0], 0))
        return np.concatenate(pooled, axis=1), places

    def pairs(self) -> dict[int, list[np.ndarray]]:
        """Tables for two neighbouring bytes at once: fewer lookups when only scores are wanted."""
        out = {}
        for width, table in self.filters.items():
            steps = []
            for j in range(0, width - 1, 2):
                steps.append((table[j][:, None] + table[j + 1][None]).reshape(CLASSES * CLASSES, FILTERS))
            if width % 2:
                steps.append(np.ascontiguousarray(table[width - 1]))
            out[width] = steps
        return out

    def log_probabilities(self, windows: np.ndarray, pairs: dict[int, list[np.ndarray]]) -> np.ndarray:
        # Positions first: sums and maxima then run along whole rows of memory.
        single = np.ascontiguousarray(windows.T).astype(np.intp)
        both = single[:-1] * CLASSES + single[1:]
        pooled = []
        for width, steps in pairs.items():
            span = WINDOW_BYTES - width + 1
            total = np.take(steps[0], both[:span], axis=0, mode="clip")
            for j, table in enumerate(steps[1:], 1):
                source = both if len(table) == CLASSES * CLASSES else single
                total += np.take(table, source[2 * j : 2 * j + span], axis=0, mode="clip")
            pooled.append(np.maximum(total.max(axis=0) + self.bias[width], 0))
        return log_softmax(np.concatenate(pooled, axis=1) @ self.output + self.output_bias)


def log_softmax(logits: np.ndarray) -> np.ndarray:
    shifted = logits - logits.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


class Adam:
    def __init__(self, values: list[np.ndarray]) -> None:
        self.values = values
        self.first = [np.zeros_like(v) for v in values]
        self.second = [np.zeros_like(v) for v in values]
        self.step = 0

    def move(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for v, m, s, g in zip(self.values, self.first, self.second, gradients):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.99**self.step)) + 1e-8)


def train(windows: np.ndarray, target: np.ndarray, languages: list[str]) -> Network:
    """Softmax regression on the pooled responses, filters included, by Adam on small batches."""
    random = np.random.default_rng(11)
    network = Network(
        languages,
        {w: (0.3 * random.standard_normal((w, CLASSES, FILTERS))).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        (0.1 * random.standard_normal((FILTERS * len(WIDTHS), max(1, len(languages))))).astype(np.float32),
        np.zeros(max(1, len(languages)), np.float32),
    )
    if len(languages) < 2:
        return network
    values = [*network.filters.values(), *network.bias.values(), network.output, network.output_bias]
    optimizer = Adam(values)
    for _ in range(EPOCHS):
        order = random.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            block = windows[rows]
            pooled, places = network.responses(block)
            wrong = np.exp(log_softmax(pooled @ network.output + network.output_bias))
            wrong[np.arange(len(rows)), target[rows]] -= 1
            wrong /= len(rows)
            back = (wrong @ network.output.T) * (pooled > 0)
            tables, biases = [], []
            column_of = np.broadcast_to(np.arange(FILTERS), (len(rows), FILTERS))
            for i, width in enumerate(WIDTHS):
                own = back[:, i * FILTERS : (i + 1) * FILTERS]
                table = np.zeros((width, CLASSES, FILTERS), np.float32)
                for j in range(width):
                    seen = np.take_along_axis(block, places[width] + j, axis=1)
                    np.add.at(table[j], (seen, column_of), own)
                tables.append(table)
                biases.append(own.sum(axis=0))
            optimizer.move([*tables, *biases, pooled.T @ wrong, wrong.sum(axis=0)])
    return network


def training_windows(docs: DataFrame, doc_id: str, text: str, lang: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of at most SAMPLE_DOCS documents, spread over the languages and over each text."""
    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{lang}` as lang")
    rows = rows.filter(f"lang is not null and doc_id is not null and {fold('doc_id', FOLDS)} != {HELD_OUT}")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(256).collect()
    if not counts:
        return np.zeros((0, WINDOW_BYTES), np.uint8), np.zeros(0, np.int64), []
    share = max(1, SAMPLE_DOCS // len(counts))
    # One scan for all languages; each task leaves out what is beyond the share before the shuffle.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.filter(F.col("lang").isin([r["lang"] for r in counts]))
    chosen = chosen.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= share).drop("place")
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("window", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            languages, ids = column(batch, "lang").to_pylist(), column(batch, "doc_id").to_pylist()
            for i, content in enumerate(column(batch, "text")):
                raw = np.frombuffer((content.as_py() or "").encode(), np.uint8)
                if not _LETTER[raw].any():
                    continue
                found = windows_of(raw)
                at = np.unique(np.linspace(0, len(found) - 1, SAMPLE_WINDOWS).astype(int))
                out.extend((ids[i], languages[i], int(j), found[j].tobytes()) for j in at)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    small_batches(docs.sparkSession)
    texts = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    # At most SAMPLE_DOCS ids.
    sample = texts.join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id").select("doc_id", "lang", "text")
    found = sample.mapInArrow(work, "doc_id long, lang string, part int, window binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("part", "ascending"), ("window", "ascending")])
    if not found.num_rows:
        return np.zeros((0, WINDOW_BYTES), np.uint8), np.zeros(0, np.int64), []
    names = sorted(set(found["lang"].to_pylist()))
    windows = np.frombuffer(b"".join(found["window"].to_pylist()), np.uint8).reshape(-1, WINDOW_BYTES)
    return windows, np.array([names.index(x) for x in found["lang"].to_pylist()]), names


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from text and non-null lang of documents outside the held-out fold, at most SAMPLE_DOCS
    of them, evenly by language (the 256 most frequent). Null texts and texts without a letter are
    `und` with score 1; so are all texts, with score 0, when there is nothing to learn from. A null
    id is not held out. Repeated rows get equal answers, ties go to the first name. An empty table
    gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    trained = train(*training_windows(docs, doc_id, text, lang))
    # Plain arrays of a size that does not depend on the data.
    sent = spark.sparkContext.broadcast(
        (trained.languages, trained.filters, trained.bias, trained.output, trained.output_bias)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*sent.value)
        pairs = net.pairs()

        def predict(batch: pa.RecordBatch) -> dict:
            texts = column(batch, "text")
            names, scores = [], []
            for first, end, content, bounds in chunks(texts):
                parts = [windows_of(content[bounds[i] : bounds[i + 1]]) for i in range(end - first)]
                windows = np.concatenate(parts)
                owner = np.repeat(np.arange(end - first), [len(p) for p in parts])
                if net.languages:
                    found = [
                        net.log_probabilities(windows[at : at + BLOCK], pairs)
                        for at in range(0, len(windows), BLOCK)
                    ]
                    weight = (windows != CLASS_OF[32]).sum(axis=1, dtype=np.float64) + 1e-9
                    totals = np.zeros((end - first, len(net.languages)))
                    np.add.at(totals, owner, np.concatenate(found) * weight[:, None])
                    share = totals / np.bincount(owner, weight, minlength=end - first)[:, None]
                    sure = np.exp(log_softmax(share))
                for i in range(end - first):
                    raw = content[bounds[i] : bounds[i + 1]]
                    known = bool(_LETTER[raw].any()) and has_letter(raw.tobytes().decode())
                    if not known or not net.languages:
                        names.append(NO_LANGUAGE)
                        scores.append(0.0 if known else 1.0)
                    else:
                        names.append(net.languages[int(sure[i].argmax())])
                        scores.append(float(sure[i].max()))
            return {"doc_id": column(batch, "doc_id"), "lang_pred": names, "score": scores}

        yield from per_batch(_LABELLED, predict)(batches)

    small_batches(spark)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    found = rows.mapInArrow(work, "doc_id long, lang_pred string, score double")
    held_out = F.coalesce(F.expr(f"{fold('doc_id', FOLDS)} = {HELD_OUT}"), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
