"""Near duplicates against all pairs compared on plain Python sets."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from plaint.llm import neardup

SPACE = " \t\n\r\x0b\x0c"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words, word = [], ""
    for c in lowered(text) + " ":
        if c in SPACE:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, left) in enumerate(sets):
        for j, right in sets[:a]:
            both = len(left & right)
            if i is not None and j is not None and both and 100 * both >= 75 * len(left | right):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((str(i), len(s), find(i) if i is not None else None, i is None or find(i) == i) for i, s in sets)


def found(frame):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def near_copies(seed=3):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefghij", k=5))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(random.randint(60, 160))]
        for _ in range(random.randint(2, 14)):
            copy = list(base)
            for _ in range(random.randint(0, 9)):
                copy[random.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    shared = [word() for _ in range(70)]
    rows += [" ".join([word() for _ in range(20)] + shared + [word() for _ in range(20)]) for _ in range(30)]
    random.shuffle(rows)
    return rows


def test_all_links_of_near_copies(docs):
    rows = near_copies()
    assert found(neardup.near_duplicates(docs(rows))) == brute(list(enumerate(rows)))


def test_large_buckets_are_cut_by_a_second_band(docs, monkeypatch):
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 2)
    rows = near_copies(5)
    assert found(neardup.near_duplicates(docs(rows))) == brute(list(enumerate(rows)))


def test_pairs_that_share_only_a_large_bucket(docs, monkeypatch):
    signatures = neardup.signatures

    def one_shared_band(*args):
        keys = "transform(bands, (b, i) -> if(i = 0, 7L, xxhash64(i, doc_id)))"
        return signatures(*args).withColumn("bands", F.expr(keys))

    monkeypatch.setattr(neardup, "signatures", one_shared_band)
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 3)
    texts = [[f"{i}w{j}" for j in range(60)] for i in range(9)]
    # Near copies of texts that are not the hub of the bucket.
    texts += [[*texts[i][:-2], "x", "y"] for i in (2, 5, 5, 8)]
    rows = [" ".join(t) for t in texts]
    expected = brute(list(enumerate(rows)))
    assert sum(not kept for *_, kept in expected) == 4
    assert found(neardup.near_duplicates(docs(rows))) == expected


def test_large_groups_are_compared_by_blocks(docs, monkeypatch):
    monkeypatch.setattr(neardup, "LARGE_GROUP", 1)
    monkeypatch.setattr(neardup, "QUERY_BLOCK", 2)
    monkeypatch.setattr(neardup, "MEMBER_BLOCK", 3)
    rows = near_copies(8)
    assert found(neardup.near_duplicates(docs(rows))) == brute(list(enumerate(rows)))


def test_odd_rows(docs):
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one two"),
        (5, "One  TWO"),
        (6, "ÉTÉ one two three four"),
        (7, "été one two three four"),
        (8, "a b c d e " * 400),
        (9, "a b c d e " * 401),
        (9, "a b c d e " * 401),
        (None, "one two"),
        (None, None),
        (10, "one two"),
    ]
    answer = found(neardup.near_duplicates(docs(rows)))
    assert answer == brute(rows)


def test_empty_table(docs):
    assert found(neardup.near_duplicates(docs([(1, "x")]).limit(0))) == []


def test_sketches_estimate_high_similarities():
    hashes = neardup.MinHash()
    random.seed(1)
    items = np.array([random.getrandbits(64) for _ in range(2_000)], np.uint64)
    apart = []
    for share in (0.9, 0.75, 0.3, 0.0):
        common = int(round(1000 * 2 * share / (1 + share)))
        left, right = items[:1000], items[1000 - common : 2000 - common]
        sketches = [hashes.sketch(hashes.minima(np.unique(side))) for side in (left, right)]
        apart.append(int(np.bitwise_count((sketches[0] ^ sketches[1]).view(np.uint64)).sum()))
    assert apart[0] < apart[1] < neardup.MOST_DIFFERENT < apart[2] < apart[3]
