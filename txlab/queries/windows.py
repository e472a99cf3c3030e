"""W: window-shaped steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.operators import windows as W
from txlab.queries.oracle import choice, on_tx, rank
from txlab.queries.registry import query
from txlab.sources.ledger import ledger
from txlab.sources.staging import stage


@query(
    "w1_row_key",
    on_tx(f"SELECT tx_id, customer_id, {rank('row', 'tx_id', 'customer_id')} - 1 AS row_key FROM tx"),
)
def row_key(spark, sf_dir):
    return W.row_key(stage(ledger(spark, sf_dir, ("tx_id", "customer_id"))))


@query(
    "w2_first_broadcast",
    on_tx(
        """SELECT tx_id, CASE WHEN category <> 'Income' THEN bank_from ELSE first_value(bank_from)
             OVER (PARTITION BY customer_id, category = 'Income' ORDER BY tx_date, tx_id) END AS bank_from
        FROM tx"""
    ),
)
def first_broadcast(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "tx_date", "category", "bank_from"))
    taken = W.first_value_broadcast(stage(rows), F.col("category") == S.INCOME, "bank_from")
    return taken.select("tx_id", "bank_from")


TILED = """tiled AS (SELECT *, {rank} AS position
  FROM tx WHERE category = 'Utilities')""".format(
    rank=rank("tile", "tx_id", "customer_id, date_trunc('month', tx_date)", "description")
)


@query(
    "w3_tile",
    on_tx(
        f"""SELECT tx_id, {choice(S.BANKS, 'tile', 'customer_id', 'position')} AS bank_to
        FROM tiled""",
        TILED,
    ),
)
def tile(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "tx_date", "category", "description"))
    utilities = stage(rows.filter("category = 'Utilities'"))
    tiled = W.tile_by_position(utilities, S.BANKS, "bank_to")
    return tiled.select("tx_id", "bank_to")


@query(
    "w4_group_total",
    on_tx(
        """SELECT tx_id, case_id, CAST(sum(CAST(amount AS DECIMAL(18,2)))
               OVER (PARTITION BY case_id) AS DOUBLE) AS group_total FROM tx"""
    ),
)
def group_total(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "case_id", "amount"))
    return W.group_total_on_rows(rows).drop("amount")


@query(
    "w5_income_flag",
    on_tx(
        """SELECT customer_id, first_income, coalesce(first_income > cut, false) AS high_income
        FROM (SELECT customer_id, arg_min(amount, (tx_date, tx_id))
                FILTER (WHERE category = 'Income') AS first_income FROM tx GROUP BY customer_id),
             (SELECT quantile_cont(amount, 0.9) AS cut FROM tx WHERE category = 'Income')"""
    ),
)
def income_flag(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "tx_date", "category", "amount"))
    return W.income_rank_flag(stage(rows))
