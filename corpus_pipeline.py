"""A corpus pipeline of five stages over ``documents``, and the registry of the corpus queries.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again before the next. All but the last keep the columns of
``docs`` and only leave out rows:

1. ``language_id``: documents whose language can't be told go.
2. ``toxicity``: documents with a toxicity of at least 0.5 go.
3. ``near_dedup``: of each group of near copies (5-word shingles, similarity of
   at least 0.8) the smallest doc_id stays.
4. ``decontaminate``: documents that hold 10 words in a row of a benchmark item,
   or a whole shorter item, go.
5. ``tokens``: ids of each document and their number.

Null and empty texts: stage 1 leaves them out, as they have no language. Rows
without doc_id pass the other stages on their text alone. Rows that are equal in
doc_id and text are one document from stage 3 on. Extra columns are kept,
whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlab.llm import language, toxicity
from txlab.llm.common import read, ship, text_key
from txlab.llm.decontamination import passages
from txlab.llm.near_duplicates import near_duplicates
from txlab.llm.pieces import encode_and_decode
from txlab.llm.queries import ORACLE, QUERIES
from txlab.sources.staging import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = language.fit(docs)
    # One struct holds the input's columns, so that theirs can't clash with those of the evidence.
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        F.col("source").cast("string").alias("host"),
        language.main_language(F.col("lang")).alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        language.text_evidence(F.col("text"), model, spark).alias("text_evidence"),
    )
    if not model.languages:
        return language.decide(rows, model, ()).filter("accepted").select("_row.*")
    # Written, as the priors and the decision both read it.
    rows = stage(rows, "zstd")
    tables = language.gather(rows.drop("_row"), len(model.languages))
    return language.decide(rows, model, tables).filter("accepted").select("_row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    learn = ~toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), learn)
    return docs.filter(toxicity.score(F.col("text"), model, spark)["score"] < 0.5)


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that are (``left_semi``) or aren't (``left_anti``) among ``doc_id, _text`` of ``keys``."""
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_key"))
    same = docs["doc_id"].eqNullSafe(keys["_id"]) & (text_key(docs["text"]) == keys["_key"])
    return docs.join(keys, same, how)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = stage(near_duplicates(docs, size=5, percent=80))
    copies = stage(found.filter(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct())
    left = docs.join(copies, docs["doc_id"] == copies["_id"], "left_anti")
    repeated = stage(found.filter("n_rows > 1 AND doc_id IS NOT NULL").select("doc_id", "_text").distinct())
    if repeated.isEmpty():
        return left
    once = _matching(left, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return _matching(left, repeated, "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    hits = passages(docs, read(spark, sf_dir, "benchmark")).filter("first IS NOT NULL")
    return _matching(docs, stage(hits.select("doc_id", "_text").distinct()), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    coded = encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=False)
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return coded.select("doc_id", n_tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

#: Models and the tokenizer can't be expressed in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, writing and reading each stage's rows."""
    docs = read(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def registry():
    """Named queries of the operators and of the pipeline, and their SQL."""
    oracle = dict(ORACLE) if ORACLE_SQL is None else {**ORACLE, "pipeline": ORACLE_SQL}
    return {**QUERIES, "pipeline": run}, oracle
