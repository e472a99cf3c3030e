"""Every named query agrees with its SQL in DuckDB."""

import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
from txlab.queries import load

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = load().QUERIES, load().ORACLE


# The smallest tables hold fewer fraud rows than these jobs may draw for one customer.
LARGER = {
    "k9_inject_labels": "/root/testdata/sf0.01",
    "k9_inject_with_replacement": "/root/testdata/sf0.01",
    "k11_final_bank_data": "/root/testdata/sf0.01",
}


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime) and value.time() == datetime.min.time():
        return value.date().isoformat()
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    return value


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in places) for row in rows),
        key=lambda row: [(v is None, str(v)) for v in row],
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir):
    sf_dir = LARGER.get(name, sf_dir)
    frame = QUERIES[name](spark, sf_dir)
    ours = ordered(frame.columns, frame.collect())
    assert name in ORACLE, "every query here has SQL to compare with"
    with duck(sf_dir) as connection:
        relation = connection.sql(ORACLE[name])
        assert sorted(frame.columns) == sorted(relation.columns)
        assert ours == ordered(relation.columns, relation.fetchall())


def test_entry(spark):
    flows = entry.entry(spark)
    assert flows.columns == ["bank_from", "bank_to", "n"]
    assert flows.count() > 0
