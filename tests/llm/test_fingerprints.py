"""Locally consistent parsing, and fingerprints of documents and their edits."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from plaint.llm import fingerprints
from plaint.llm.batches import Powers


def text(n, letters="abcdefgh é"):
    return "".join(random.choices(letters, k=n))


def brute(rows):
    """The same columns document by document, each fingerprint made alone."""
    powers = Powers()
    order = sorted(rows, key=lambda r: r[0])
    one = lambda t: fingerprints.fingerprints([t.encode()], powers)[0]
    out = []
    for k, (i, own) in enumerate(order):
        own, after = own or "", order[(k + 1) % len(order)][1] or ""
        changed = own[: len(own) - len(own) // 4] + after[: len(own) // 4]
        a, b, c = one(own), one(changed), one(after)
        near = fingerprints.likeness(a, b), fingerprints.likeness(a, c)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(own), sha, fingerprints.spelled(a), fingerprints.spelled(b), *near))
    return out


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_documents_in_order_of_ids(docs):
    random.seed(1)
    rows = [(i * 3 - 20, random.choice([None, "", text(3), text(50), text(3_000)])) for i in range(60)]
    rows += [(1_000, "z" * 5_000), (1_001, "z" * 5_000), (1_002, "\U0001f600" * 9)]
    random.shuffle(rows)
    assert found(fingerprints.document_fingerprints(docs(rows))) == brute(rows)


def test_one_row_and_no_rows(docs):
    rows = [(4, "abcdefgh")]
    assert found(fingerprints.document_fingerprints(docs(rows))) == brute(rows)
    assert found(fingerprints.document_fingerprints(docs(rows).limit(0))) == []


def test_repeated_rows_and_null_ids(docs):
    rows = [(None, "first text"), (None, "first text"), (2, "abc"), (2, "abc"), (3, None)]
    answer = fingerprints.document_fingerprints(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in answer) == [("2", 3), ("2", 3), ("3", 0), ("None", 10), ("None", 10)]
    assert len({r.fingerprint for r in answer if r.doc_id == 2}) == 1


def test_equal_substrings_share_their_inner_phrases():
    random.seed(2)
    powers, shared = Powers(), text(3_000).encode()
    names = []
    for around in (0, 1, 17, 500):
        whole = text(around).encode() + shared + text(around).encode()
        rows = np.array([0, len(whole)])
        content = np.frombuffer(whole, np.uint8)
        level, symbols = fingerprints._BYTE_NAMES[content], content
        for _ in range(3):
            level, rows = fingerprints.parse_level(level, symbols, rows, powers)
            symbols = level
        names.append(set(level.tolist()))
    # All but a few phrases at the edges are the same at any offset.
    for other in names[1:]:
        assert len(names[0] & other) >= len(names[0]) - 8


def test_likeness_follows_the_share_of_text():
    random.seed(3)
    powers, base, other = Powers(), text(8_000), text(8_000)
    prints = lambda t: fingerprints.fingerprints([t.encode()], powers)[0]
    near = [fingerprints.likeness(prints(base), prints(base[: 8_000 - cut] + other[:cut])) for cut in (0, 400, 2_000, 6_000, 8_000)]
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[1] > 0.7 and near[-1] < 0.1


def test_labels_differ_between_neighbours():
    symbols = np.random.default_rng(4).integers(0, 1 << 63, 5_000, dtype=np.int64).astype(np.uint64)
    labels = fingerprints.toss(symbols, np.array([0, 1_000]))
    assert labels.max() < 8 and (labels[1:] != labels[:-1])[np.arange(4_999) != 999].all()
