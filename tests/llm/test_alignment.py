from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from plaint.llm import alignment
from plaint.llm.alignment import Side, align_tokens, byte_level_side, groups_of, overlaps, piece_side


def libraries():
    """Ids and token bytes by the two libraries, without the operator's own reading of them."""
    import tokenizers

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    level = {}
    for n in [*range(256), *range(256, 0xD800, 64), *range(0xE000, 0x110000, 4096)]:
        # The pre-tokenizer spells each byte of a character as one letter.
        raw = chr(n).encode()
        spelled = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(n))[0][0]
        level.update(zip(spelled, raw))

    def encode(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(level.get(c, 0) for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        return ids_a, bytes_a, ids_b, bytes_b

    return encode


def brute(texts, encode):
    """Rows by the contract, with loops over bytes."""
    parts = []
    for text in texts:
        a, bytes_a, b, bytes_b = encode(text) if text else ([], [], [], [])
        raw = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            parts.append(None)
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        at = [[k for k, x in enumerate(side) for _ in x] for side in (bytes_a, bytes_b)]
        links = sorted(set(zip(*at)))
        groups, done = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            now = [ends[0].index(cut) + 1, ends[1].index(cut) + 1]
            groups.append(",".join(map(str, a[done[0] : now[0]])) + "|" + ",".join(map(str, b[done[1] : now[1]])))
            done = now
        parts.append((a, b, groups, [(a[x], b[y]) for x, y in links]))
    counts = Counter(pair for p in parts if p for pair in set(p[3]))
    highest: dict = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    rows = []
    for p in parts:
        if p is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = p
        best = sum(counts[x] == highest[x[0]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return rows


TEXTS = [
    "The cat sat on the mat.", "the cat", "the cat", None, "", " ", "  two  spaces\tand\nlines ", "a▁b holds the mark",
    "naïve café 日本語 \U0001f600 ©", "<|endoftext|> <s> </s> <unk> <0x41>", "x" * 700, "՘ unassigned", "\x00\x01 control",
    "12345 67,890.12", "word " * 400, "ｆｕｌｌ ﬁ width", "é combining", "The cat sat on the mat.",
]


def found_rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_against_loops(docs):
    rows = list(enumerate(TEXTS))
    expected = sorted(((i, *r) for i, r in zip(range(len(TEXTS)), brute(TEXTS, libraries()))), key=str)
    assert found_rows(align_tokens(docs(rows))) == expected
    assert any(r[1] for r in expected) and any(not r[1] for r in expected)


def test_blocks_change_no_result(docs, monkeypatch):
    whole = found_rows(align_tokens(docs(list(enumerate(TEXTS)))))
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 1)
    monkeypatch.setattr(alignment, "ROWS_OUT", 1)
    assert found_rows(align_tokens(docs(list(enumerate(TEXTS)), parts=1), block_bytes=30)) == whole


def test_odd_rows(docs):
    rows = [(None, "some words here"), (5, "some words here"), (5, "some words here"), (5, "other words"), (6, None)]
    expected = sorted(((i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows], libraries()))), key=str)
    assert found_rows(align_tokens(docs(rows))) == expected
    assert align_tokens(docs([])).collect() == []
    assert align_tokens(docs([(1, None), (2, "")])).count() == 2


def test_groups_and_overlaps():
    a, b = np.array([0, 3, 5]), np.array([0, 2, 4, 5])
    a_ends, b_ends = np.array([3, 5, 9]), np.array([2, 4, 5, 9])
    group = groups_of(np.concatenate([a, b]), np.concatenate([a_ends, b_ends]))
    assert group.tolist() == [0, 0, 1, 0, 0, 0, 1]
    left, right = overlaps(a, a_ends, b, b_ends)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 3)]


def test_other_tokenizers(docs):
    """A tokenizer of letters beside one of whole texts; ids without a place in the text give zeros."""

    def sides():
        def letters(texts):
            return [[ord(c) for c in " " + t] for t in texts]

        names = [bytes([n]) for n in range(128)]
        return Side(letters, names), Side(lambda texts: [[0] for _ in texts], [b" ab"])

    found = {r.doc_id: r for r in align_tokens(docs(["ab", "ac", "ab"]), sides).collect()}
    assert (found[0].n_a, found[0].n_b, found[0].n_groups, found[0].n_links) == (3, 1, 1, 3)
    assert found[1].n_a == 0 and found[1].groups_sha256 == ""
    assert (found[2].n_best, found[2].count_sum) == (3, 6)
    assert found[0].groups_sha256 == hashlib.sha256(b"32,97,98|0").hexdigest()


def test_sides_cover_every_code_point():
    a, b = byte_level_side(), piece_side()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    known = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}a 1{c} {c}" for c in known[i : i + 256]) for i in range(0, len(known), 256)]
    ids = a.encode(texts)
    assert ids == [e.ids for e in exact.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert all(b"".join(a.token_bytes[i] for i in own) == (" " + t).encode() for own, t in zip(ids, texts))
    joined = [b"".join(b.token_bytes[i] for i in own) for own in b.encode(texts)]
    assert sum(j == (" " + t).encode() for j, t in zip(joined, texts)) > len(texts) // 2


def test_whole_table_against_loops(spark):
    from plaint.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    kept = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = sorted(((r.doc_id, *row) for r, row in zip(kept, brute([r.text for r in kept], libraries()))), key=str)
    assert found_rows(QUERIES["op13_coalesced_alignment"](spark, sf_dir)) == expected
