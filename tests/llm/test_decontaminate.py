"""Contamination against windows searched one by one."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from plaint.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, width=13):
    windows = []
    for item, text in items:
        w = words_of(text)
        if w:
            windows += [(item, w[k : k + width]) for k in range(max(1, len(w) - width + 1))]
    out = []
    for i, text in rows:
        w, hit, names = words_of(text), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    if item is not None:
                        names.add(str(item))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def found(frame):
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((str(r.doc_id), *(r[n] for n in names)) for r in frame.collect())


def words(n):
    return [random.choice("abcdefghijklm") * random.randint(1, 3) for _ in range(n)]


@pytest.fixture
def benchmark(spark):
    def make(items):
        return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as window", "1 as words")

    return make


def cases():
    random.seed(1)
    items = [(i, " ".join(words(n))) for i, n in enumerate((1, 2, 3, 5, 12, 13, 14, 40, 40))]
    items += [(20, items[7][1]), (None, " ".join(words(14))), (21, None), (22, ""), (23, "?!")]
    rows = []
    for i in range(80):
        parts = words(random.randint(0, 40))
        for _, text in random.sample(items, 2):
            own = (text or "").upper().split()
            cut = random.randint(0, 4) if random.random() < 0.5 else 0
            parts += own[cut : len(own) - random.randint(0, 3)] + words(random.randint(0, 40))
        rows.append((i, random.choice([" ", ", ", "\n", "__"]).join(parts)))
    rows += [(100, None), (101, ""), (102, "...")] + [(103, items[7][1])] * 2
    rows += [(None, items[6][1] + " été"), (None, None)]
    return rows, items


def test_windows_of_all_lengths(docs, benchmark):
    rows, items = cases()
    assert found(decontaminate.contamination(docs(rows), benchmark(items))) == brute(rows, items)


def test_without_broadcasts(docs, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    rows, items = cases()
    assert found(decontaminate.contamination(docs(rows), benchmark(items))) == brute(rows, items)


def test_share_of_hit_words(docs, benchmark):
    item = " ".join(f"w{i}" for i in range(13))
    rows = [(n, item + " x" * n) for n in (246, 247, 248, 3)]
    answer = {r.doc_id: r.contaminated for r in decontaminate.contamination(docs(rows), benchmark([(1, item)])).collect()}
    assert answer == {246: True, 247: True, 248: False, 3: True}


def test_empty_tables(docs, benchmark):
    rows, items = [(1, "a b"), (2, None)], [(1, "a")]
    assert found(decontaminate.contamination(docs(rows), benchmark(items).limit(0))) == brute(rows, [])
    assert found(decontaminate.contamination(docs(rows).limit(0), benchmark(items))) == []
