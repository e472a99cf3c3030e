"""The transaction ledger as a view over star-schema tables.

Only the tables that the wanted columns need are joined.  That leaves the
result unchanged because every foreign key of ``lineitem`` and ``orders`` finds
exactly one row (tests check this on the given tables).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlab.sources.files import read_table

# Roles of the part types in the transaction model.
CATEGORY_OF_TYPE = {
    "PROMO": "Cash Withdrawal",
    "ECONOMY": "Income",
    "SMALL": "Utilities",
    "LARGE": "Housing",
    "MEDIUM": "Investment",
    "STANDARD": "Groceries",
}
FRAUD_OF_PRIORITY = {
    "1-URGENT": "Romance",
    "2-HIGH": "Investment",
    "3-MEDIUM": "Purchase",
    "4-NOT SPECIFIED": "Impersonation",
}
# The text whose presence marks an incoming transfer in these tables.
INCOMING_TEXT = "ring"


_TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", _TABLES[name], fmt="parquet")


def _case(column: str, values: dict[str, str], default: str) -> str:
    rules = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in values.items())
    return f"CASE {column} {rules} ELSE '{default}' END"


_LABELLED = "l_returnflag = 'R' AND l_quantity >= 49"
# Column: its expression and the tables it needs beside `lineitem`.
_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "tx_id": (
        "concat_ws('|', string(l_orderkey), string(l_linenumber), string(l_partkey), "
        "string(l_suppkey), string(int(l_quantity)), string(date(l_shipdate)))",
        (),
    ),
    "case_id": ("l_orderkey", ()),
    "customer_id": ("o_custkey", ("orders",)),
    "tx_date": ("date(o_orderdate)", ("orders",)),
    "category": (_case("p_type", CATEGORY_OF_TYPE, "Shopping"), ("part",)),
    "subcategory": ("p_brand", ("part",)),
    "description": ("p_name", ("part",)),
    "amount": ("l_extendedprice", ()),
    "tx_type": ("if(l_linestatus = 'F', 'income', 'spending')", ()),
    "labelled": (_LABELLED, ()),
    "fraud_type": (
        f"if({_LABELLED}, {_case('o_orderpriority', FRAUD_OF_PRIORITY, 'CEO')}, 'none')",
        ("orders",),
    ),
    "bank_from": ("concat('bank_', string(c_nationkey % 5))", ("orders", "customer")),
    "bank_to": (
        "if(p_type = 'PROMO', null, concat('bank_', string(s_nationkey % 5)))",
        ("part", "supplier"),
    ),
}

LEDGER_COLUMNS = (
    "tx_id",
    "customer_id",
    "tx_date",
    "category",
    "subcategory",
    "description",
    "amount",
    "tx_type",
    "fraud_type",
    "bank_from",
    "bank_to",
)

_JOINS = (
    ("part", "l_partkey", "p_partkey"),
    ("supplier", "l_suppkey", "s_suppkey"),
    ("orders", "l_orderkey", "o_orderkey"),
    ("customer", "o_custkey", "c_custkey"),
)


def ledger(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = LEDGER_COLUMNS
) -> DataFrame:
    """The ledger's ``columns``, one row per line item."""
    wanted = {name: _COLUMNS[name] for name in columns}
    needed = {name for _, needs in wanted.values() for name in needs}
    rows = table(spark, sf_dir, "lineitem")
    for name, foreign_key, key in _JOINS:
        if name in needed:
            rows = rows.join(table(spark, sf_dir, name), F.col(foreign_key) == F.col(key))
    return rows.selectExpr(*[f"{expression} AS {name}" for name, (expression, _) in wanted.items()])
