"""Alignment of the tokens of two tokenizers over the same bytes, by interval coalescing.

All tokens of both sides are sorted by where they start; the running maximum of their ends tells
where no token reaches across, and there a group ends. Inside, each pair of tokens of the two sides
whose bytes overlap is a link. A pair of ids counts the documents that hold it linked.

The counts are of the whole corpus, yet no table of (document, pair) is shuffled: documents are
worked on in blocks, a block sends each of its pairs once, and gets each pair's count back once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaint.llm.batches import column, small_batches, staged
from plaint.llm.packing import PATTERN

# Text bytes of a block, and of the texts whose tokens are sorted together.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 19
ROWS_OUT = 512
SPACE = "▁"

_LINKED = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("places", pa.binary()),
        ("times", pa.binary()),
        ("pairs", pa.list_(pa.int64())),
        ("docs", pa.list_(pa.int64())),
    ]
)
LINKED_DDL = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places binary, times binary, pairs array<long>, docs array<long>"
)
_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
ALIGNED_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


@dataclass
class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    token_bytes: list[bytes]
    widths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.widths = np.array([len(b) for b in self.token_bytes], np.int64)


def byte_level_side(path: str | None = None, ranks_path: str | None = None) -> Side:
    """A space and the text by byte_bpe_50k.json, special strings as plain text.

    The ranks file holds the same vocabulary and is four times as fast. Texts with a character that
    the two libraries cut differently (their Unicode tables may differ) go to the tokenizer."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    alike = set(map(chr, range(128)))

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    def same(text: str) -> bool:
        for c in set() if text.isascii() else set(text).difference(alike):
            probe = f"a{c}a1{c}1 .{c}. {c} x"
            if slow(probe) != fast.encode_ordinary(probe):
                return False
            alike.add(c)
        return True

    def encode(texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        return [fast.encode_ordinary(t) if same(t) else slow(t) for t in spaced]

    of_id = {rank: token for token, rank in ranks.items()}
    return Side(encode, [of_id.get(i, b"") for i in range(max(of_id) + 1)])


def piece_side(path: str | None = None) -> Side:
    """The text by piece_bpe_32k.model, which puts a space before it."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))

    def token(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()

    return Side(lambda texts: model.encode(texts, num_threads=1), [token(i) for i in range(model.get_piece_size())])


def groups_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of the group of each token. Sides come one after the other in `starts`."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.append(True, starts[order][1:] >= reach[:-1])[: len(order)]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of all overlapping pairs; each side lies in order and without gaps."""
    low = np.searchsorted(b_ends, a_starts, side="right")
    high = np.searchsorted(b_starts, a_ends, side="left")
    counts = high - low
    a = np.repeat(np.arange(len(a_starts)), counts)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)


class Aligner:
    """Tokens, groups and links of texts, with the documents of one block."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        self.ids = max(len(a.token_bytes), len(b.token_bytes))
        self.spelled = [f"{i}{end}" for end in ("", ",", "|", ";") for i in range(self.ids)]
        self.start()

    def start(self) -> None:
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.n_pairs = 0
        self.size = 0

    def spell(self, side: np.ndarray, group: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> list[str]:
        """Digest of the groups of each row: ids of both sides in decimals."""
        order = np.argsort(2 * group + side, kind="stable")
        side, group, ids, rows = side[order], group[order], ids[order], rows[order]
        mark = np.where(group[1:] != group[:-1], 3, np.where(side[1:] != side[:-1], 2, 1))
        last = np.append(rows[1:] != rows[:-1], True)
        codes = (np.where(last, 0, np.append(mark, 0)) * self.ids + ids).tolist()
        edges = [0, *(np.flatnonzero(last) + 1).tolist()]
        name = self.spelled.__getitem__
        return [hashlib.sha256("".join(map(name, codes[x:y])).encode()).hexdigest() for x, y in zip(edges, edges[1:])]

    def add(self, doc_ids: list[int | None], texts: list[str | None]) -> None:
        """Align some texts and keep the results for the block."""
        filled = [t for t in texts if t]
        found = {}
        both = zip(filled, self.a.encode(filled), self.b.encode(filled)) if filled else ()
        numbers = (i for i, t in enumerate(texts) if t)
        for row, (text, a, b) in zip(numbers, both):
            raw = b" " + text.encode()
            if all(b"".join(map(s.token_bytes.__getitem__, ids)) == raw for s, ids in ((self.a, a), (self.b, b))):
                found[row] = (a, b)
        self.size += sum(map(len, filled))
        zeros = np.zeros(0, np.uint32).tobytes()
        own: list[tuple] = [(i, 0, 0, 0, 0, "", zeros, zeros, self.n_pairs) for i in doc_ids]
        if found:
            self._align(found, own)
        self.rows.extend(own)

    def _align(self, found: dict[int, tuple[list[int], list[int]]], own: list[tuple]) -> None:
        kept = np.array(list(found))
        n_a, n_b = (np.array([len(pair[k]) for pair in found.values()]) for k in (0, 1))
        a = np.concatenate([np.array(pair[0], np.int64) for pair in found.values()])
        b = np.concatenate([np.array(pair[1], np.int64) for pair in found.values()])
        # Both sides cover the same bytes of each text, so texts lie one behind the other for both.
        a_ends, b_ends = np.cumsum(self.a.widths[a]), np.cumsum(self.b.widths[b])
        a_starts, b_starts = a_ends - self.a.widths[a], b_ends - self.b.widths[b]
        rows = np.concatenate([np.repeat(kept, n_a), np.repeat(kept, n_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        group = groups_of(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]))
        first = np.unique(group[: len(a)], return_index=True)[1]
        n_groups = np.bincount(rows[first], minlength=len(own))
        digests = self.spell(side, group, np.concatenate([a, b]), rows)
        at_a, at_b = overlaps(a_starts, a_ends, b_starts, b_ends)
        owner = rows[at_a]
        n_links = np.bincount(owner, minlength=len(own))
        pairs, place = np.unique((a[at_a] << 32) | b[at_b], return_inverse=True)
        linked, times = np.unique(owner * len(pairs) + place, return_counts=True)
        place, times = (linked % len(pairs)).astype(np.uint32), times.astype(np.uint32)
        cuts = np.searchsorted(linked, np.append(kept, kept[-1] + 1) * len(pairs))
        for k, row in enumerate(found):
            mine = slice(cuts[k], cuts[k + 1])
            counts = (int(n_a[k]), int(n_b[k]), int(n_groups[row]), int(n_links[row]))
            own[row] = (own[row][0], *counts, digests[k], place[mine].tobytes(), times[mine].tobytes(), self.n_pairs)
        self.pairs.append(pairs)
        self.n_pairs += len(pairs)

    def take(self, block: int) -> Iterator[pa.RecordBatch]:
        """The block: one row per document, with places in the block's list of pairs, and one row
        with that list and in how many of the block's documents each pair is linked."""
        pairs, place = np.unique(np.concatenate(self.pairs or [np.zeros(0, np.int64)]), return_inverse=True)
        docs = np.zeros(len(pairs), np.int64)
        for low in range(0, len(self.rows), ROWS_OUT):
            out = []
            for *row, at, times, offset in self.rows[low : low + ROWS_OUT]:
                mine = place[np.frombuffer(at, np.uint32).astype(np.int64) + offset]
                docs[mine] += 1
                out.append((block, *row, mine.astype(np.uint32).tobytes(), times, None, None))
            yield self._batch(out)
        if len(pairs):
            yield self._batch([(block, *[None] * 8, pairs, docs)])
        self.start()

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LINKED)], schema=_LINKED)


def _link(sides: Callable[[], tuple[Side, Side]], block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 40
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*sides())
            ids, texts = column(batch, "doc_id").to_pylist(), column(batch, "text")
            first, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text.as_py() or "")
                if size < CHUNK_BYTES and i + 1 < len(ids):
                    continue
                aligner.add(ids[first : i + 1], texts[first : i + 1].to_pylist())
                first, size = i + 1, 0
                if aligner.size >= block_bytes:
                    yield from aligner.take(block)
                    block += 1
        if aligner and aligner.rows:
            yield from aligner.take(block)

    return run


def _count_links(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block beside the counts of its pairs."""
    count = np.zeros(counts.num_rows, np.int64)
    best = np.zeros(counts.num_rows, bool)
    place = counts["place"].to_numpy()
    count[place] = counts["n"].to_numpy()
    best[place] = counts["best"].to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for places, times in zip(docs["places"].to_pylist(), docs["times"].to_pylist()):
        at, often = np.frombuffer(places, np.uint32), np.frombuffer(times, np.uint32).astype(np.int64)
        n_best.append(int(often[best[at]].sum()))
        count_sum.append(int((often * count[at]).sum()))
    found = {**{n: docs[n] for n in _ALIGNED.names if n in docs.column_names}, "n_best": n_best, "count_sum": count_sum}
    return pa.table([found[n] for n in _ALIGNED.names], schema=_ALIGNED)


def public_sides() -> tuple[Side, Side]:
    return byte_level_side(), piece_side()


def align_tokens(
    docs: DataFrame,
    sides: Callable[[], tuple[Side, Side]] = public_sides,
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: n_a, n_b tokens, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``sides`` makes both tokenizers within a task. Texts that are null or empty, or whose tokens do
    not join to a space and the text on both sides, have no tokens: zeros, an empty digest, and no
    part in the counts. Repeated rows and rows with one id or none are documents of their own. An
    empty table gives an empty result. Other columns are ignored.

    A block's memory follows `block_bytes` (a longer text is a block alone). What is shuffled is one
    row per block and distinct pair, and the packed links of the documents.
    """
    small_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    linked = staged(rows.mapInArrow(_link(sides, block_bytes), LINKED_DDL), "links")

    in_blocks = linked.filter("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "docs")))
    in_blocks = in_blocks.selectExpr("block", "pos as place", "col.pairs as pair", "col.docs as docs")
    counts = in_blocks.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32))
    counts = staged(counts, "pairs")
    # One row per id of the first vocabulary.
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    counts = counts.join(highest, "a").selectExpr("pair", "n", "n = highest as best")
    counted = in_blocks.join(counts, "pair").select("block", "place", "n", "best")

    documents = linked.filter("pairs is null").drop("pairs", "docs").withColumnRenamed("block", "owner")
    return documents.groupBy("owner").cogroup(counted.groupBy("block")).applyInArrow(_count_links, ALIGNED_DDL)
