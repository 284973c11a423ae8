from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plaint.llm import tokencounts
from plaint.llm.tokencounts import Merges, TokenCounter, byte_letters, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH)


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def one_pair_at_a_time(word: bytes, merges: list[tuple[str, str]]) -> int:
    """Merge the leftmost lowest-ranked pair until none is left."""
    letters = {b: a for a, b in byte_letters().items()}
    ranks = {pair: i for i, pair in enumerate(merges)}
    symbols = [letters[b] for b in word]
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return len(symbols)
        _, i = min(found)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_rounds_against_one_pair_at_a_time():
    merges = [("a", "a"), ("a", "b"), ("aa", "a"), ("aa", "aa"), ("b", "ab"), ("aaa", "b"), ("c", "aa")]
    names = [*byte_letters(), *(a + b for a, b in merges)]
    made = Merges(byte_letters(), merges, {n: i for i, n in enumerate(dict.fromkeys(names))})
    draw = random.Random(3)
    words = [bytes(draw.choice(b"aabc") for _ in range(draw.randrange(12))) for _ in range(500)]
    words += [b"a" * n for n in range(20)]
    assert made.counts(words).tolist() == [one_pair_at_a_time(w, merges) for w in words]
    assert made.counts([]).tolist() == [] and made.counts([b"", b""]).tolist() == [0, 0]


def test_vocabulary_that_needs_another_order():
    merges = [("ab", "c"), ("a", "b")]
    names = [*byte_letters(), "ab", "abc"]
    with pytest.raises(ValueError, match="ranks before"):
        Merges(byte_letters(), merges, {n: i for i, n in enumerate(names)})


def test_hard_texts_against_the_library(counter, exact):
    draw = random.Random(5)
    texts = [
        "", " ", "\n\n  x \t y  ", "a<|endoftext|>b  <|endoftext|><|endoftext|>", "don't I'LL we'll 'S",
        "a" * 5_000, " " * 5_000, "՘x՘ 1", "日本語" * 200, "é‍\U0001f468‍\U0001f469", "\x1c\x85 \x00",
        "".join(draw.choice("abcdefghij") for _ in range(3_000)),
        "".join(chr(draw.choice([draw.randrange(1, 0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(4_000)),
    ]
    assert counter.counts([None, *texts]) == [0, *(len(exact.encode(t, add_special_tokens=False).ids) for t in texts)]


def test_every_code_point(counter, exact):
    """Two of each character beside letters, digits and spaces, in runs of 256 code points."""
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c}a 1{c} {c}" for c in known[i : i + 256]) for i in range(0, 0x30000, 256)]
    assert counter.counts(texts) == [len(e.ids) for e in exact.encode_batch(texts, add_special_tokens=False)]


def test_bounds_change_no_result(counter, monkeypatch):
    texts = [" ".join(str(n * k) for n in range(300)) + "x" * 100 for k in range(20)]
    expected = counter.counts(texts)
    for name in ("REMEMBERED", "LONGEST_REMEMBERED", "WORDS_AT_ONCE", "CHARS_AT_ONCE"):
        monkeypatch.setattr(tokencounts, name, 3)
    assert TokenCounter(PATH).counts(texts) == expected


def test_odd_rows(docs, exact):
    rows = [(1, None), (2, ""), (None, "two words"), (4, "same"), (4, "same"), (4, "other text"), (7, "long " * 3_000)]
    found = sorted(map(tuple, token_counts(docs(rows), limit=1).collect()), key=str)
    sizes = [len(exact.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert found == sorted(((i, len((t or "").encode()), n, n > 1) for (i, t), n in zip(rows, sizes)), key=str)
    assert token_counts(docs([])).collect() == []
    assert token_counts(docs(rows)).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_whole_table_against_the_library(spark, exact):
    from plaint.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_rank_synchronous_counts"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes = [len(e.ids) for e in exact.encode_batch(list(texts.values()), add_special_tokens=False)]
    assert found == {i: (len(t.encode()), n, n > 512) for (i, t), n in zip(texts.items(), sizes)}
