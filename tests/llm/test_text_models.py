"""Quality votes and the language network: held-out accuracy, exact parts, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plaint.llm import language, quality
from plaint.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def is_fold(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_held_out_quality(spark):
    scored = {r.doc_id: r for r in QUERIES["op6_quality_votes"](spark, SF_DIR).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for key, row in scored.items():
        assert row.held_out == is_fold(key, 5, 0) and 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    held = [(scored[k].predicted, q) for k, q in truth.items() if k in scored and scored[k].held_out]
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) > 0.93


def test_words_tell_texts_of_one_shape_apart(spark, docs):
    """Junk of plain words: both labels have five-letter lower-case words, from different vocabularies."""
    random.seed(6)
    words = ["".join(random.choices("abcdefghijkl", k=5)) for _ in range(240)]
    kinds = [words[:120], words[120:]]
    rows = [" ".join(random.choices(kinds[i % 2], k=random.randint(30, 300))) for i in range(400)]
    labels = [(i, i % 2, 0) for i in range(400)]
    answer = quality.quality_scores(docs(rows), labels_frame(spark, labels)).collect()
    held = [r.predicted == r.doc_id % 2 for r in answer if r.held_out]
    assert len(held) > 50 and sum(held) / len(held) > 0.93


def test_terms_of_a_bag():
    powers = quality.Powers()
    texts = ["The cat, the CAT", "the cat, the cat", "eht tac, eht tac", "", None, "the cat, the cat"]
    one, lower, turned, empty, null, again = quality.bags(pa.array(texts), powers)
    content = slice(quality.SHAPE_TERMS, None)
    assert np.array_equal(one[content], lower[content]) and not np.array_equal(one, lower)
    assert not np.array_equal(lower[content], turned[content])
    assert np.array_equal(lower[: quality.SHAPE_TERMS], turned[: quality.SHAPE_TERMS])
    assert not empty.any() and not null.any() and np.array_equal(lower, again)
    # Trigrams do not reach into the texts before and after.
    alone = quality.bags(pa.array(["the cat, the cat"]), powers)[0]
    assert np.array_equal(alone, lower)
    row, term = quality.trigrams(np.frombuffer(b"ab c\xc3\xa9", np.uint8), np.array([0, 4, 6]))
    assert row.tolist() == [0, 0, 0, 1, 1]
    codes = [b" ab", b"ab ", b" c ", b" \xc3\xa9", b"\xc3\xa9 "]
    assert term.tolist() == [((int.from_bytes(c, "big") * 0x9E3779B1) % 2**32 >> 8) % quality.TRIGRAM_TERMS for c in codes]


def test_votes_are_exact_cosine_neighbours():
    random = np.random.default_rng(1)
    rows = random.random((300, quality.TERMS)).astype(np.float32)
    labels = random.integers(0, 2, 300).astype(float)
    votes = quality.fit_votes(rows, labels)
    asked = random.random((40, quality.TERMS)).astype(np.float32)
    for row, score in zip(asked, votes.score(asked)):
        point = row @ votes.projection
        cosines = votes.vectors @ (point / np.linalg.norm(point))
        near = np.argsort(-cosines)[: quality.NEIGHBOURS]
        weight = cosines[near].astype(float) ** quality.SHARPNESS
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-3)


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text", "1 as label")


def test_odd_rows_of_quality(spark, docs):
    random.seed(1)
    good = [" ".join("".join(random.choices("abcdefgh", k=random.randint(2, 8))) for _ in range(40)) + "." for _ in range(60)]
    bad = ["!!! $$$ " * 30 + "".join(random.choices("abc", k=4)) for _ in range(60)]
    rows = [*good, *bad, None, "", " \n", "word " * 20_000, *good[:1]]
    labels = [(i, int(i < 60), 0) for i in range(120)] + [(1, 1, 0), (2, None, 0), (3, 7, 0), (None, 1, 0), (999, 0, 0)]
    answer = {r.doc_id: r for r in quality.quality_scores(docs(rows), labels_frame(spark, labels)).collect()}
    assert len(answer) == len(rows)
    assert all(answer[i].predicted == 1 for i in range(60)) and all(answer[i].predicted == 0 for i in range(60, 120))
    assert [answer[i].score for i in (120, 121, 122)] == [0.5, 0.5, 0.5]
    assert answer[124].score == answer[0].score
    none = quality.quality_scores(docs(rows), labels_frame(spark, labels).limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(docs(rows).limit(0), labels_frame(spark, labels)).collect() == []
    assert quality.quality_scores(docs([(None, "x")]), labels_frame(spark, labels)).collect()[0].held_out is False


def test_held_out_language(spark):
    answer = QUERIES["op7_byte_network_languages"](spark, SF_DIR).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in answer) == sorted(truth)
    assert all(r.held_out == is_fold(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in answer)
    held = [r.lang_pred == truth[r.doc_id] for r in answer if r.held_out]
    assert len(held) > 200 and sum(held) / len(held) > 0.97


def test_scores_by_pairs_are_the_network(monkeypatch):
    random = np.random.default_rng(2)
    windows = random.integers(0, language.CLASSES, (20, language.WINDOW_BYTES)).astype(np.uint8)
    target = random.integers(0, 3, 20)
    monkeypatch.setattr(language, "EPOCHS", 1)
    network = language.train(windows, target, ["a", "b", "c"])
    pooled, _ = network.responses(windows)
    plain = language.log_softmax(pooled @ network.output + network.output_bias)
    assert np.allclose(plain, network.log_probabilities(windows, network.pairs()), atol=1e-4)


def test_odd_rows_of_language(spark, docs):
    random.seed(3)
    one = ["".join(random.choices("abc ", k=400)) for _ in range(60)]
    two = ["".join(random.choices("xyz ", k=400)) for _ in range(60)]
    pairs = [(i, t) for i, t in enumerate([*one, *two])]
    frame = docs(pairs).drop("lang").selectExpr("*", "case when doc_id = 5 then null when doc_id < 60 then 'one' else 'two' end as lang")
    odd = docs([(200, None), (201, ""), (202, "12 ?!"), (203, "abc cab" * 9_000), (203, "abc cab" * 9_000), (None, "zyx " * 50), (204, "你")])
    both = frame.unionByName(odd.withColumn("lang", odd.lang.cast("string")).selectExpr(*[c for c in odd.columns if c != "lang"], "cast(null as string) as lang"))
    answer = [(r.doc_id, r.lang_pred, r.score) for r in language.languages(both).collect()]
    found = dict((a[0], a[1]) for a in answer)
    assert all(found[i] == ("one" if i < 60 else "two") for i in range(120))
    assert [found[i] for i in (200, 201, 202, 203, None)] == ["und", "und", "und", "one", "two"]
    assert found[204] in ("one", "two") and len(answer) == 127
    nothing = language.languages(both.withColumn("lang", both.lang.substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') as lang"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.languages(both.limit(0)).collect() == []
