"""R: seeded samples and draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import draws as D
from txlab.operators import sampling as R
from txlab.queries.joins import FRAUD, labelled
from txlab.queries.oracle import (
    between,
    choice,
    day,
    exact_mean,
    index,
    integer,
    on_tx,
    rank,
    truncated_normal,
    u,
)
from txlab.queries.registry import query
from txlab.sources.ledger import ledger
from txlab.sources.staging import stage
from txlab.sources.views import catalogue

CATALOGUE = f"""bounds AS (SELECT subcategory, min(amount) / 1000 AS "min", max(amount) / 1000 AS "max",
    {exact_mean('amount')} / 1000 AS "mean" FROM tx GROUP BY subcategory),
catalogue AS (SELECT * FROM (SELECT DISTINCT category, subcategory, description FROM tx)
  JOIN bounds USING (subcategory))"""


@query(
    "r1_sample_n",
    on_tx(
        f"""SELECT tx_id, customer_id FROM tx
        QUALIFY {rank('sample', 'tx_id', 'customer_id')} <= 3"""
    ),
)
def sample_n(spark, sf_dir):
    return R.sample_n(ledger(spark, sf_dir, ("tx_id", "customer_id")), ["customer_id"], 3, ["tx_id"])


@query(
    "r1_sample_n_other_seed",
    on_tx(
        f"""SELECT tx_id, customer_id FROM tx
        QUALIFY {rank('sample', 'tx_id', 'customer_id', seed=7)} <= 3"""
    ),
)
def sample_n_other_seed(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id"))
    return R.sample_n(rows, ["customer_id"], 3, ["tx_id"], seed=7)


@query(
    "r1_sample_n_large",
    on_tx(
        f"""SELECT tx_id, category FROM tx
        QUALIFY {rank('sample', 'tx_id', 'category')} <= 2500"""
    ),
)
def sample_n_large(spark, sf_dir):
    """More rows of a group than Spark cuts groups to in each task."""
    return R.sample_n(ledger(spark, sf_dir, ("tx_id", "category")), ["category"], 2500, ["tx_id"])


@query("r2_share", on_tx(f"SELECT tx_id, category FROM tx WHERE {u('share', 'tx_id')} < 0.25"))
def share(spark, sf_dir):
    return R.sample_share(ledger(spark, sf_dir, ("tx_id", "category")), 0.25, ["tx_id"])


def _fraction(numerator: int, denominator: int) -> str:
    return on_tx(
        f"""SELECT tx_id, category FROM tx
        QUALIFY {rank('fraction', 'tx_id', 'category')}
          <= (count(*) OVER (PARTITION BY category) * {numerator}) // {denominator}"""
    )


@query("r2_fraction_half", _fraction(1, 2))
def fraction_half(spark, sf_dir):
    rows = stage(ledger(spark, sf_dir, ("tx_id", "category")))
    return R.sample_fraction(rows, ["category"], 1, 2, ["tx_id"])


@query("r2_fraction_third", _fraction(1, 3))
def fraction_third(spark, sf_dir):
    rows = stage(ledger(spark, sf_dir, ("tx_id", "category")))
    return R.sample_fraction(rows, ["category"], 1, 3, ["tx_id"])


@query("r2_fraction_most", _fraction(5, 6))
def fraction_most(spark, sf_dir):
    rows = stage(ledger(spark, sf_dir, ("tx_id", "category")))
    return R.sample_fraction(rows, ["category"], 5, 6, ["tx_id"])


@query(
    "r3_with_replacement",
    on_tx(
        f"""SELECT t.tx_id, t.category, f.tx_id AS drawn_id, f.amount AS drawn_amount
        FROM (SELECT tx_id, category FROM tx WHERE fraud_type = 'none') t
        JOIN (SELECT category, count(*) AS n FROM f GROUP BY category) s USING (category)
        JOIN (SELECT *, {rank('pool', 'tx_id', 'category')} - 1 AS pos FROM f) f
          ON f.category = t.category AND f.pos = {index('s.n', 'replace', 't.tx_id')}""",
        FRAUD,
    ),
)
def with_replacement(spark, sf_dir):
    members = labelled(spark, sf_dir, ("tx_id", "category", "amount"))
    members = members.withColumnsRenamed({"tx_id": "drawn_id", "amount": "drawn_amount"})
    pool = R.index_pool(stage(members), ["category"], ["drawn_id"])
    rows = ledger(spark, sf_dir, ("tx_id", "category", "labelled")).filter(~F.col("labelled"))
    return R.pick(rows.drop("labelled"), pool, ["tx_id"], "replace", ["drawn_id", "drawn_amount"])


@query("r4_int", on_tx(f"SELECT tx_id, {integer(1, 6, 'int', 'tx_id')} AS drawn FROM tx"))
def draw_int(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id",))
    return rows.withColumn("drawn", D.draw_int(1, 6, "tx_id", salt="int"))


@query("r5_uniform", on_tx(f"SELECT tx_id, {between(0.1, 0.5, 'uniform', 'tx_id')} AS drawn FROM tx"))
def draw_uniform(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id",))
    return rows.withColumn("drawn", D.draw_uniform(0.1, 0.5, "tx_id", salt="uniform"))


@query(
    "r6_choice",
    on_tx(
        f"""SELECT tx_id, {choice(S.BANKS, 'row', 'tx_id')} AS row_bank,
               {choice(S.BANKS, 'customer', 'customer_id')} AS customer_bank FROM tx"""
    ),
)
def draw_choice(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id"))
    return rows.select(
        "tx_id",
        D.draw_choice(S.BANKS, "tx_id", salt="row").alias("row_bank"),
        D.draw_choice(S.BANKS, "customer_id", salt="customer").alias("customer_bank"),
    )


@query(
    "r7_truncnorm",
    on_tx(
        f"""SELECT tx_id, round({truncated_normal('"min"', '"max"', '"mean"', 'normal', 'tx_id')}, 6) AS drawn
        FROM tx JOIN bounds USING (subcategory)""",
        CATALOGUE,
    ),
)
def draw_truncated_normal(spark, sf_dir):
    bounds = catalogue(spark, sf_dir).select("subcategory", "min", "max", "mean").distinct()
    rows = ledger(spark, sf_dir, ("tx_id", "subcategory")).join(bounds, "subcategory")
    drawn = D.draw_truncated_normal("min", "max", "mean", "tx_id", salt="normal")
    return rows.select("tx_id", F.round(drawn, 6).alias("drawn"))


@query(
    "r8_date",
    on_tx(
        f"""SELECT tx_id, CAST({day("CAST(date_trunc('month', tx_date) AS DATE)", 'last_day(tx_date)', 'date', 'tx_id')}
               AS DATE) AS drawn FROM tx"""
    ),
)
def draw_date(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "tx_date"))
    drawn = D.draw_date(F.trunc("tx_date", "MM"), F.last_day("tx_date"), "tx_id", salt="date")
    return rows.select("tx_id", drawn.alias("drawn"))


@query(
    "r9_entities",
    on_tx(
        f"""SELECT customer_id FROM (SELECT DISTINCT customer_id FROM tx)
        QUALIFY {rank('sel', 'customer_id')} <= floor(count(*) OVER () * 0.3::DOUBLE)"""
    ),
)
def entities(spark, sf_dir):
    return R.select_entities(ledger(spark, sf_dir, ("customer_id",)), "customer_id", 0.3)
