"""Sum-of-squares packing of token sequences into windows of fixed length.

Each task packs the documents of its own input partition: no shuffle, and only the open windows
are in memory. A document longer than a window fills whole windows first; its rest is placed
online where it minimises the sum of squared counts of partially filled windows per fill level.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plaint.llm.batches import column, small_batches

WINDOW = 2_048
END_ID = 1
# Open windows that a task holds (up to 16 MB of ids). Beyond it the emptiest half fills the others.
MOST_OPEN = 2_048
PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
PIECES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES_DDL.split(", ")])
ROWS_OUT = 4_096
SPECIAL = "<|endoftext|>"
# The vocabulary's splitting pattern in its equivalent form without backtracking.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def default_encoder() -> Callable[[str], list[int]]:
    """Ids of byte_bpe_50k.json. The ranks file holds the same vocabulary and is several times as
    fast; a text that spells a special token goes to the tokenizer itself."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list = []

    def encode(text: str) -> list[int]:
        if SPECIAL not in text:
            return fast.encode_ordinary(text)
        if not exact:
            exact.append(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
        return exact[0].encode(text, add_special_tokens=False).ids

    return encode


@dataclass
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray


@dataclass
class Windows:
    """The open windows of one task by fill level, and the pieces of those already closed."""

    first_sequence: int
    window: int = WINDOW
    most_open: int = MOST_OPEN
    levels: np.ndarray = field(init=False)
    open: dict[int, list[list[Piece]]] = field(default_factory=dict)
    n_open: int = 0
    # Pieces that were taken out of the window in which they had been placed.
    moved: int = 0
    rows: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.levels = np.zeros(self.window + 1, np.int64)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Cut off whole windows; place the rest."""
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.close([Piece(doc_id, start, len(ids), ids[start : start + self.window])])
        if whole < len(ids):
            self.place(Piece(doc_id, whole, len(ids), ids[whole:]))

    def best_level(self, size: int) -> int:
        """The level whose window, moved up by `size`, gives the smallest sum of squares.

        Moving a window from level a to b changes the sum by 2 * (count[b] - count[a]) + 2. A new
        window adds 2 * count[b] + 1, and a full one leaves: 1 - 2 * count[a]. Ties: the fullest.
        """
        top = self.window - size
        change = 2 * (self.levels[size : self.window + 1] - self.levels[: top + 1]) + 2
        change[0] -= 1
        change[top] -= 1 + 2 * self.levels[self.window]
        usable = self.levels[: top + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self.best_level(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if level + size == self.window:
            self.close(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            self.drain(self.most_open // 2)

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            self.rows.append((p.doc_id, p.start, len(p.ids), crc, p.doc_tokens, self.first_sequence, offset))
            offset += len(p.ids)
        self.first_sequence += 1

    def drain(self, most: int) -> None:
        """Leave at most so many windows open: the emptiest are given up piece by piece, whole where
        they fit and else cut, to fill the fullest. Pieces of all other windows stay where they are."""
        rest = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open.clear()
        self.levels[:] = 0
        first, given = 0, []
        while first < len(rest) and len(rest) - first + bool(given) > most:
            pieces = rest[first]
            room = self.window - sum(len(p.ids) for p in pieces)
            while room and (given or len(rest) - first > 1):
                if not given:
                    given = rest.pop()
                    self.moved += len(given)
                piece = given.pop()
                pieces.append(Piece(piece.doc_id, piece.start, piece.doc_tokens, piece.ids[:room]))
                if room < len(piece.ids):
                    given.append(Piece(piece.doc_id, piece.start + room, piece.doc_tokens, piece.ids[room:]))
                room -= len(pieces[-1].ids)
            if room:
                break
            self.close(pieces)
            first += 1
        rest = rest[first:]
        if given:
            rest.append(given)
        for pieces in rest:
            level = sum(len(p.ids) for p in pieces)
            self.open.setdefault(level, []).append(pieces)
            self.levels[level] += 1
        self.n_open = len(rest)

    def finish(self) -> None:
        """Close all open windows; at most one is not full."""
        self.drain(0)
        for windows in self.open.values():
            for pieces in windows:
                self.close(pieces)
        self.open.clear()
        self.levels[:] = 0
        self.n_open = 0

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in PIECES]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=PIECES)


def pack_sequences(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], list[int]]] = default_encoder,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: which ids of which document stand where in which sequence.

    Every document ends in id 1, so a null or empty text is one id. Sequences are full but for the
    last one of each input partition: when its documents are through, pieces of its emptiest windows
    fill the fullest ones, cut where they do not fit. Sequence ids are unique over all tasks and the same when a task
    is repeated on the same rows. Repeated rows and null ids are packed like any other. An empty
    table gives no piece. Other columns are ignored.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        windows = Windows((context.partitionId() if context else 0) << 40, window)
        encode = None
        for batch in batches:
            encode = encode or encoder()
            for key, content in zip(column(batch, "doc_id").to_pylist(), column(batch, "text")):
                ids = encode(content.as_py() or "")
                ids.append(END_ID)
                windows.add(key, np.array(ids, np.uint32))
                if len(windows.rows) >= ROWS_OUT:
                    yield windows.taken()
        windows.finish()
        if windows.rows:
            yield windows.taken()

    small_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    return rows.mapInArrow(pack, PIECES_DDL)
