"""The stages of the corpus pipeline, each against what its operator decides."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from plaint.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def oracle(name, documents):
    connection = duckdb.connect()
    connection.register("documents", documents)
    connection.execute(f"create view benchmark as select * from '{SF_DIR}/benchmark.parquet'")
    return connection.execute(ORACLES[name]).df()


def test_columns_and_whole_documents(stages):
    for before, after in zip(stages[:3], stages[1:4]):
        assert list(after.columns) == corpus_pipeline.COLUMNS
        assert set(after.doc_id) <= set(before.doc_id) and after.doc_id.is_unique


def test_near_duplicates_go(stages):
    answer = oracle("op1_odd_sketch_near_duplicates", stages[0])
    assert sorted(stages[1].doc_id) == sorted(answer[answer.kept].doc_id)


def test_repeated_passages_go(stages):
    answer = oracle("op2_phrase_automata", stages[1]).set_index("doc_id")
    before = stages[1].set_index("doc_id").text
    for row in stages[2].itertuples():
        if answer.n_removed[row.doc_id]:
            assert len(row.text.split()) == answer.n_words[row.doc_id] - answer.n_removed[row.doc_id]
            assert row.n_chars == len(row.text)
        else:
            assert row.text == before[row.doc_id]


def test_contaminated_documents_go(stages):
    answer = oracle("op5_prefix_filtered_decontamination", stages[2])
    assert sorted(stages[3].doc_id) == sorted(answer[~answer.contaminated].doc_id)


def test_all_that_is_left_is_packed(stages):
    pieces = stages[4]
    assert set(pieces.doc_id) == set(stages[3].doc_id)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_run_gives_the_rows_of_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = corpus_pipeline.run(spark, SF_DIR).groupBy("doc_id").sum("length").collect()
    expected = stages[4][columns].groupby("doc_id").length.sum().to_dict()
    assert {r[0]: r[1] for r in total} == expected


def test_odd_documents(spark, docs, tmp_path):
    """Nulls, repeats and empty tables pass through every stage."""
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, "word " * 5_000), (3, "word " * 5_000), (4, "plain words here")]
    frame = docs(rows).select(*corpus_pipeline.COLUMNS)
    for source in (frame, frame.limit(0)):
        current = source
        for _, stage in corpus_pipeline.STAGES:
            current = stage(spark, current, SF_DIR)
        assert current.count() >= 0


def passage(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def kept(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_near_copies_by_id_and_text(spark, docs):
    """Two texts under one id are two documents, and so are rows without an id."""
    a, b, c, d = (passage(n, 80) for n in "abcd")
    near = f"{a} more"
    rows = [(1, a), (3, near), (3, b), (4, b), (2, b), (2, a), (None, near), (None, c), (None, c), (5, d), (5, d), (None, None), (None, None), (None, "")]
    after = corpus_pipeline.minhash_near_dedup(spark, docs(rows).select(*corpus_pipeline.COLUMNS), SF_DIR)
    # Of b, id 4 names one text; ids 2 and 3 name two each and come after it.
    expected = [(1, a), (4, b), (None, c), (5, d), (None, None), (None, None), (None, "")]
    assert kept(after) == sorted(expected, key=str)


def test_contaminated_texts_by_id_and_text(spark, docs):
    item = next(r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() if len(r.text.split()) > 20)
    clean = passage("clean", 40)
    rows = [(1, item), (2, item), (2, clean), (3, clean), (3, item), (None, item), (None, clean), (None, None), (4, ""), (4, ""), (6, f"{item} {clean}")]
    after = corpus_pipeline.benchmark_decontamination(spark, docs(rows).select(*corpus_pipeline.COLUMNS), SF_DIR)
    expected = [(2, clean), (3, clean), (None, clean), (None, None), (4, ""), (4, "")]
    assert kept(after) == sorted(expected, key=str)


def test_repeated_passages_of_rows_without_an_id(spark, docs):
    shared = passage("s", 60)
    rows = [(1, f"{passage('a', 9)} {shared}"), (None, f"{shared} {passage('b', 9)}"), (None, passage("c", 50)), (None, None)]
    after = corpus_pipeline.substring_dedup(spark, docs(rows).select(*corpus_pipeline.COLUMNS), SF_DIR)
    expected = [(1, passage("a", 9)), (None, passage("b", 9)), (None, passage("c", 50)), (None, None)]
    assert kept(after) == sorted(expected, key=str)


def test_texts_under_one_id_are_cut_each_by_itself(spark, docs):
    def unlike(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    shared, other = unlike("s", 60), unlike("t", 60)
    rows = [(1, f"{unlike('a', 9)} {shared}"), (2, f"{unlike('b', 9)} {other}")]
    rows += [(3, f"{shared} {unlike('c', 9)}"), (3, f"{unlike('d', 9)} {other}"), (3, unlike("e", 70))]
    after = corpus_pipeline.substring_dedup(spark, docs(rows).select(*corpus_pipeline.COLUMNS), SF_DIR)
    expected = [(1, unlike("a", 9)), (2, unlike("b", 9)), (3, unlike("c", 9)), (3, unlike("d", 9)), (3, unlike("e", 70))]
    assert sorted((r.doc_id, r.text) for r in after.collect()) == expected
