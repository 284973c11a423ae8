"""Packed sequences read back into the ids of every document."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plaint.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_default_ids_are_the_tokenizers(tokenizer):
    encode = packing.default_encoder()
    random.seed(1)
    alphabet = "ab Z\n\t.,'!éß你\U0001f600 09  s't\x00́"
    texts = ["".join(random.choices(alphabet, k=n)) for n in range(120)]
    texts += ["", "   ", "a  ", "it's I'll", "x <|endoftext|> y", "\r\n \n"]
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def restored(pieces, ids, window):
    """Checks every piece; returns the lengths of the sequences."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        part = np.array(own[p.start : p.start + p.length], "<u4")
        assert p.ids_crc32 == zlib.crc32(part.tobytes()) and 0 < p.length <= window
        documents[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for key, own in ids.items():
        at = 0
        for start, length in sorted(documents[key]):
            assert start == at
            at += length
        assert at == len(own)
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    return lengths


def test_every_id_in_one_piece(docs, tokenizer):
    random.seed(2)
    rows = [" ".join("".join(random.choices("abcdef", k=5)) for _ in range(random.choice([3, 40, 300, 2500]))) for _ in range(120)]
    rows += [None, "", "x"]
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(rows)}
    lengths = restored(packing.pack_sequences(docs(rows, parts=2)).collect(), ids, packing.WINDOW)
    # At most one sequence a task is not full.
    assert sum(n < packing.WINDOW for n in lengths) <= 2


def test_few_open_windows(docs):
    windows = packing.Windows(0, 100, most_open=3)
    random.seed(3)
    ids = {}
    for i in range(200):
        ids[i] = [i] * random.randint(1, 250)
        windows.add(i, np.array(ids[i], np.uint32))
    windows.finish()

    class Row:
        def __init__(self, values):
            self.__dict__.update(zip(packing.PIECES.names, values))

    lengths = restored([Row(r) for r in windows.rows], ids, 100)
    assert sum(n < 100 for n in lengths) <= 1


def test_only_pieces_of_the_emptiest_windows_move():
    windows = packing.Windows(0, 100)
    for i, size in enumerate([90, 70, 45, 35]):
        piece = packing.Piece(i, 0, size, np.full(size, i, np.uint32))
        windows.open[size] = [[piece]]
        windows.levels[size] = 1
    windows.n_open = 4
    windows.drain(3)
    # The smallest fills the largest, and what is left of it stays open beside the others.
    assert {r[5]: r[6] + r[2] for r in windows.rows} == {0: 100} and windows.moved == 1
    assert sorted(windows.open) == [25, 45, 70] and windows.n_open == windows.levels.sum() == 3
    windows.finish()
    ends = {}
    for doc_id, start, length, _, _, sequence, offset in windows.rows:
        ends[sequence] = max(ends.get(sequence, 0), offset + length)
    assert sorted(ends.values()) == [40, 100, 100] and windows.n_open == 0 and not windows.open
    spans = sorted((r[0], r[1], r[2]) for r in windows.rows)
    assert {d: sum(n for k, _, n in spans if k == d) for d in range(4)} == {0: 90, 1: 70, 2: 45, 3: 35}


def test_most_pieces_stay_where_the_squares_put_them():
    windows = packing.Windows(0)
    random.seed(8)
    for i in range(6_000):
        windows.add(i, np.zeros(min(int(random.lognormvariate(5.5, 1)) + 1, 20_000), np.uint32))
    windows.finish()
    assert windows.moved < 0.1 * len(windows.rows)


def test_level_of_the_smallest_sum_of_squares():
    random.seed(4)
    for _ in range(300):
        windows = packing.Windows(0, 12)
        windows.levels[1:12] = [random.choice([0, 0, 1, 2, 5]) for _ in range(11)]
        size = random.randint(1, 11)

        def after(level):
            counts = windows.levels.copy()
            if level:
                counts[level] -= 1
            if level + size < 12:
                counts[level + size] += 1
            return int((counts**2).sum())

        usable = [0] + [v for v in range(1, 13 - size) if windows.levels[v]]
        level = windows.best_level(size)
        assert level in usable and after(level) == min(map(after, usable))


def test_repeated_rows_null_ids_and_no_rows(docs):
    pieces = packing.pack_sequences(docs([(None, "a b"), (5, "a b"), (5, "a b")], parts=1)).collect()
    assert sorted((str(p.doc_id), p.length) for p in pieces) == [("5", 3), ("5", 3), ("None", 3)]
    assert packing.pack_sequences(docs([(1, "x")]).limit(0)).collect() == []
