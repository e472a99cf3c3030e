"""Stages keep the columns and the clean rows, take out what they must, and bear odd rows."""

import pytest

import corpus_pipeline
from corpus_pipeline import STAGES, run

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, _id int, words int, `a.b` int, text_key string"


@pytest.fixture(scope="module")
def small(spark, sf_dir, tmp_path_factory):
    """Real documents with copies, near copies, benchmark passages and odd rows among them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    real = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    long = max((r[1] for r in real if r[2] == "en"), key=len)
    words = long.split()
    near = " ".join(["changed", *words[1:]])
    extra = [
        (10_000, long, "en", "src1", 1), (10_001, near, "en", "src1", 1), (10_001, near, "en", "src1", 1),
        (10_002, f"{passage} and then some", "en", "src1", 1), (10_003, None, "en", "src1", None),
        (10_004, "", "en", None, 0), (None, "the of and to in is it", "en", "src1", 1), (None, None, None, None, None),
    ]
    docs = [(*r, "h", 1, 2, 3, "k") for r in real + extra]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return folder, real, near


def test_stages(spark, small):
    folder, real, near = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = {}
    for name, apply in STAGES[:-1]:
        out = apply(spark, docs, folder)
        assert out.schema.names == docs.schema.names
        kept = out.collect()
        before = {r.doc_id for r in docs.collect()}
        gone[name] = before - {r.doc_id for r in kept}
        docs = spark.createDataFrame(kept, docs.schema)
    assert {10_003, 10_004} == {d for d in gone["language_id"] if d is not None}
    assert len(gone["toxicity"]) < 0.2 * len(real)
    assert 10_000 in gone["near_dedup"] | gone["toxicity"]
    assert 10_002 in gone["decontaminate"]
    assert sum(r.doc_id == 10_001 for r in docs.collect()) <= 1
    last = STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count()


def test_run_equals_the_stages(spark, small):
    folder, _, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, apply in STAGES:
        docs = apply(spark, docs, folder)
    assert sorted(map(str, run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_repeated_rows_and_empty_tables(spark, small):
    folder, _, _ = small
    rows = [(1, "one two three four five six", "en", "s", 1)] * 3 + [(2, "one two three four five six", "en", "s", 1), (None, "x y", "en", "s", 1), (None, "x y", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "h", 1, 2, 3, "k") for r in rows], SCHEMA)
    left = corpus_pipeline.near_dedup(spark, docs, folder).collect()
    assert sorted(r.doc_id or 0 for r in left) == [0, 0, 1]
    for _, apply in STAGES:
        assert apply(spark, docs.limit(0), folder).count() == 0
