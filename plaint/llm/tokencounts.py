"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

The pre-tokens of many texts lie in one numpy array of symbols, cut into sequences. A round finds
each sequence's lowest-ranked pair, merges all its occurrences there at once, and drops sequences
without a pair left; what survives is counted. A merged symbol only takes part in pairs that rank
after the pair that made it (checked when a vocabulary is read), so this gives what merging one
pair at a time gives.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plaint.llm.batches import column, per_batch, small_batches

LIMIT = 512
# Pre-tokens whose counts a worker remembers, and the longest of them in characters: what bounds
# its memory and no result.
REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 64
# Pre-tokens, and characters of texts, that are held at once.
WORDS_AT_ONCE = 1 << 17
CHARS_AT_ONCE = 1 << 19

# How byte-level BPE of this family cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NONE = np.iinfo(np.int32).max
COUNTS_DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself where it can be printed,
    else the next letter from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Merges:
    """The merges of a vocabulary as sorted arrays, and the rounds over ragged sequences."""

    def __init__(self, letters: dict[str, int], merges: list[tuple[str, str]], vocabulary: dict[str, int]) -> None:
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        born = np.full(max(vocabulary.values()) + 1, -1, np.int64)
        np.maximum.at(born, self.made, np.arange(len(merges)))
        if (np.maximum(born[left], born[right]) >= np.arange(len(merges))).any():
            raise ValueError("a pair of this vocabulary ranks before the pair that makes one of its symbols")
        keys = (left << 32) | right
        self.rank = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; NONE where no merge takes it."""
        if not len(self.keys):
            return np.full(len(left), NONE, np.int32)
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word when no pair can be merged."""
        out = np.zeros(len(words), np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        live = np.flatnonzero(sizes)
        sizes = sizes[live]
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        if not len(symbols):
            return out
        rank = np.append(self.ranks(symbols[:-1], symbols[1:]), NONE)
        rank[np.cumsum(sizes) - 1] = NONE
        while True:
            low = np.minimum.reduceat(rank, np.cumsum(sizes) - sizes)
            done = low == NONE
            if done.any():
                out[live[done]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbols, rank = symbols[stay], rank[stay]
                live, sizes, low = live[~done], sizes[~done], low[~done]
                if not len(live):
                    return out
            at = np.flatnonzero(rank == np.repeat(low, sizes))
            # Of a run of places of a symbol with itself, every second one is merged.
            new = np.append(True, np.diff(at) != 1)
            at = at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            sizes = np.add.reduceat(stay, np.cumsum(sizes) - sizes, dtype=np.int64)
            symbols, rank = symbols[stay], rank[stay]
            # Only pairs with a merged symbol have another rank now.
            place = at - np.arange(len(at))
            touched = np.concatenate([place, place[place > 0] - 1])
            rank[touched] = self.ranks(symbols[touched], symbols[np.minimum(touched + 1, len(symbols) - 1)])
            rank[np.cumsum(sizes) - 1] = NONE


class TokenCounter:
    """Counts tokens of texts as the tokenizer of a vocabulary file gives them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, cut = whole["model"], whole["pre_tokenizer"]
        plain = {"byte_fallback": False, "ignore_merges": False, "dropout": None, "end_of_word_suffix": None}
        odd = [k for k, v in plain.items() if (model.get(k) or None) != (v or None)]
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or whole["normalizer"] or model["type"] != "BPE" or odd:
            raise ValueError(f"{path} is not plain byte-level BPE")
        added = whole["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take characters around them")
        names = sorted((regex.escape(t["content"]) for t in added), key=len, reverse=True)
        self.path = path
        self.added = regex.compile("|".join(names)) if names else None
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(byte_letters(), pairs, model["vocab"])
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}
        self.long: list[str] = []
        self.alike: set[str] = set(map(chr, range(128)))
        self.exact = None

    def exact_cut(self, text: str) -> list[str]:
        """Pre-tokens as the tokenizer itself cuts them."""
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.exact.pre_tokenize_str(text)]

    def classed_alike(self, text: str) -> bool:
        """Whether the pattern and the tokenizer class all characters alike. Their Unicode tables may
        be of different versions; each new character is tried once between letters, digits and signs."""
        if text.isascii():
            return True
        for c in set(text).difference(self.alike):
            probe = f"a{c}a1{c}1 .{c}. {c} x"
            if self.exact_cut(probe) != self.pattern.findall(probe):
                return False
            self.alike.add(c)
        return True

    def words(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text between added tokens, in runs of bounded length."""
        if not self.classed_alike(text):
            yield self.exact_cut(text)
        elif len(text) <= CHARS_AT_ONCE:
            yield self.pattern.findall(text)
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while words := list(islice(found, WORDS_AT_ONCE)):
                yield words

    def learn(self, words: set[str]) -> None:
        fresh = list(words.difference(self.known))
        self.known.update(zip(fresh, self.merges.counts([w.encode() for w in fresh]).tolist()))
        self.long.extend(w for w in fresh if len(w) > LONGEST_REMEMBERED)

    def forget(self) -> None:
        for word in self.long:
            del self.known[word]
        self.long.clear()
        if len(self.known) > REMEMBERED:
            self.known.clear()

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; texts are gathered up to a bounded number of characters."""
        out = [0] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            self.learn(set().union(*(words for _, words in waiting)))
            for row, words in waiting:
                out[row] += sum(map(self.known.__getitem__, words))
            waiting.clear()
            self.forget()

        for row, text in enumerate(texts):
            if not text:
                continue
            if self.added and self.added.search(text):
                pieces = self.added.split(text)
                out[row] += len(pieces) - 1
            else:
                pieces = [text]
            for piece in pieces:
                for words in self.words(piece):
                    waiting.append((row, words))
                    held += len(words)
                    if held >= WORDS_AT_ONCE:
                        settle()
                        held = 0
        settle()
        return out


def token_counts(
    docs: DataFrame,
    vocabulary: str | None = None,
    limit: int = LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is the path of a byte-level BPE file (.json) that every executor can open; by
    default byte_bpe_50k.json of the public tokenizers. A special string inside a text is its one
    token. Null and empty texts have no bytes and no tokens. Repeated rows and null ids are counted
    like any other. An empty table gives an empty result. Other columns are ignored. Nothing is
    shuffled; a worker holds the pre-tokens of some texts and the counts of frequent ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: list[TokenCounter] = []

        def work(batch: pa.RecordBatch) -> dict:
            if not counter:
                import public_tokenizers

                counter.append(TokenCounter(vocabulary or public_tokenizers.path("byte_bpe_50k.json")))
            n_tokens = counter[0].counts(column(batch, "text").to_pylist())
            return {
                "doc_id": column(batch, "doc_id"),
                "n_bytes": column(batch, "n_bytes"),
                "n_tokens": n_tokens,
                "over_limit": [n > limit for n in n_tokens],
            }

        yield from per_batch(_COUNTS, work)(batches)

    small_batches(docs.sparkSession)
    rows = docs.selectExpr(
        f"cast(`{doc_id}` as bigint) as doc_id",
        f"cast(coalesce(octet_length(`{text}`), 0) as bigint) as n_bytes",
        f"`{text}` as text",
    )
    return rows.mapInArrow(run, COUNTS_DDL)
