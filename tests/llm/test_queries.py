"""Every corpus query with SQL agrees with it; the others have their columns and a row for each input row."""

import duckdb
import pytest

import __spark_entry__ as entry
from corpus_pipeline import registry
from tests.test_oracle import ordered

QUERIES, ORACLE = registry()
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck(sf_dir):
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    relation = duck.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert ordered(frame.columns, frame.collect()) == ordered(relation.columns, relation.fetchall())


COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_url_filter": "page_id host path rule verdict",
    "op3_sentencepiece_encode_decode": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_toxicity": "doc_id held_out score predicted",
    "op12_katz_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_language_id": "doc_id page_id language confidence accepted",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_whole_table(name, spark, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(frame.columns)
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "pages")}
    expected = {"op2_url_filter": sizes["pages"], "op6_language_id": sum(sizes.values())}
    assert frame.count() == expected.get(name, sizes["documents"])


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in entry.queries() if name[:2] == "op" and name[2].isdigit())
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()
