"""Repeated passages against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from plaint.llm import phrases

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, width=35):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + width]) for _, w in texts for k in range(len(w) - width + 1))
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - width + 1):
            if seen[tuple(words[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def found(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def words(n, letters="abcdefgh"):
    return ["".join(random.choices(letters, k=4)) for _ in range(n)]


def test_passages_of_all_lengths(docs):
    random.seed(2)
    shared = [words(n) for n in (34, 35, 36, 60, 200)]
    rows = []
    for _ in range(60):
        parts = words(random.randint(0, 60))
        for passage in random.sample(shared, random.randint(0, 3)):
            cut = random.randint(0, 20) if random.random() < 0.4 else 0
            parts += passage[cut:] + words(random.randint(0, 50))
        rows.append(random.choice([" ", "\n", "  \t"]).join(parts))
    base = words(300)
    for _ in range(8):
        copy = list(base)
        for _ in range(random.randint(0, 6)):
            copy[random.randrange(300)] = words(1)[0]
        rows.append(" ".join(copy))
    assert found(phrases.remove_repeats(docs(rows))) == brute(list(enumerate(rows)))


def test_small_shards_and_many_salts(docs, monkeypatch):
    monkeypatch.setattr(phrases, "REPS_PER_SHARD", 1)
    monkeypatch.setattr(phrases, "DOCS_PER_TASK", 2)
    random.seed(4)
    shared = words(50)
    rows = [" ".join(words(30) + shared + words(30)) for _ in range(15)]
    assert found(phrases.remove_repeats(docs(rows))) == brute(list(enumerate(rows)))


def test_odd_rows(docs):
    random.seed(3)
    passage, other = " ".join(words(40)), " ".join(words(45))
    rows = [
        (1, None),
        (2, ""),
        (3, "x " * 34),
        (4, "x " * 35),
        (5, "x " * 36),
        (6, passage),
        (7, passage),
        (7, passage),
        (8, "start " + passage + " and " + passage),
        (None, other),
        (None, None),
        (9, "é " + other),
        (10, "Case " * 40),
        (11, "case " * 40),
    ]
    assert found(phrases.remove_repeats(docs(rows))) == brute(rows)


def test_kept_text(docs):
    random.seed(6)
    shared = " ".join(words(40))
    rows = ["a  b " + shared + " c", "d " + shared, "nothing  here"]
    answer = {r.doc_id: r.kept_text for r in phrases.remove_repeats(docs(rows), with_text=True).collect()}
    assert answer == {0: "a b c", 1: "d", 2: None}


def test_different_texts_under_one_id(docs):
    random.seed(17)
    left, right = words(80), words(80)
    rows = [
        (1, " ".join(words(30) + left)),
        (2, " ".join(words(30) + right)),
        (3, " ".join(left + words(50))),
        (3, " ".join(words(20) + right + words(10))),
        (3, " ".join(words(60))),
    ]
    assert found(phrases.remove_repeats(docs(rows))) == brute(rows)


def test_empty_table(docs):
    assert found(phrases.remove_repeats(docs([(1, "x")]).limit(0))) == []
