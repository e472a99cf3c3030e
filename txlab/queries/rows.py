"""P: projections, filters and row-wise rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions.draws import draw_uniform
from txlab.operators import rows as R
from txlab.queries.oracle import between, on_tx, pairs, texts
from txlab.queries.registry import query
from txlab.sources.ledger import INCOMING_TEXT, ledger
from txlab.sources.views import customer_flags

SYNONYMS = {"Groceries": "Shopping", "Investment": "Savings"}


@query(
    "p1_rename",
    on_tx(
        """SELECT tx_id, category AS "Category", description AS transaction_description FROM tx"""
    ),
)
def rename(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category", "description"))
    return R.rename(rows, {"category": "Category", "description": "transaction_description"})


@query(
    "p2_drop",
    on_tx("SELECT * EXCLUDE (case_id, tx_type, bank_from, bank_to) FROM tx"),
)
def drop(spark, sf_dir):
    return R.drop(ledger(spark, sf_dir), ["tx_type", "bank_from", "bank_to"])


@query("p3_conform", on_tx("SELECT amount, category, tx_id FROM tx"))
def conform(spark, sf_dir):
    like = ledger(spark, sf_dir, ("amount", "category", "tx_id"))
    return R.conform(ledger(spark, sf_dir), like)


@query("p4_tag", on_tx("SELECT tx_id, amount, 'non-fraud' AS origin FROM tx"))
def tag(spark, sf_dir):
    return R.tag(ledger(spark, sf_dir, ("tx_id", "amount")), "origin", "non-fraud")


@query("p5_rescale", on_tx("SELECT tx_id, amount / 100 AS amount FROM tx"))
def rescale(spark, sf_dir):
    return R.rescale(ledger(spark, sf_dir, ("tx_id", "amount")), "amount")


@query("p6_where_eq", on_tx("SELECT tx_id, bank_to FROM tx WHERE bank_to = 'bank_1'"))
def where_eq(spark, sf_dir):
    return R.where_eq(ledger(spark, sf_dir, ("tx_id", "bank_to")), "bank_to", "bank_1")


@query("p6_where_ne", on_tx("SELECT tx_id, bank_to FROM tx WHERE bank_to <> 'bank_1'"))
def where_ne(spark, sf_dir):
    return R.where_ne(ledger(spark, sf_dir, ("tx_id", "bank_to")), "bank_to", "bank_1")


@query(
    "p6_where_ne_keep_missing",
    on_tx("SELECT tx_id, bank_to FROM tx WHERE bank_to IS DISTINCT FROM 'bank_1'"),
)
def where_ne_keep_missing(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "bank_to"))
    return R.where_ne(rows, "bank_to", "bank_1", keep_missing=True)


@query(
    "p7_where_in",
    on_tx(f"SELECT tx_id, category FROM tx WHERE category IN {texts(S.BILL_CATEGORIES)}"),
)
def where_in(spark, sf_dir):
    return R.where_in(ledger(spark, sf_dir, ("tx_id", "category")), "category", S.BILL_CATEGORIES)


@query(
    "p7_where_not_in",
    on_tx(f"SELECT tx_id, category FROM tx WHERE category NOT IN {texts(S.BILL_CATEGORIES)}"),
)
def where_not_in(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category"))
    return R.where_not_in(rows, "category", S.BILL_CATEGORIES)


@query(
    "p8_where_all",
    on_tx(
        """SELECT tx_id, category, tx_type, amount FROM tx
        WHERE NOT category = 'Housing' AND tx_type = 'spending'
          AND (amount > 50000 OR category = 'Income')"""
    ),
)
def where_all(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category", "tx_type", "amount"))
    conditions = [
        ~(F.col("category") == "Housing"),
        F.col("tx_type") == "spending",
        (F.col("amount") > 50000) | (F.col("category") == "Income"),
    ]
    return R.where_all(rows, conditions)


@query("p9_where_null", on_tx("SELECT tx_id, category FROM tx WHERE bank_to IS NULL"))
def where_null(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category", "bank_to"))
    return R.where_null(rows, "bank_to").drop("bank_to")


@query("p10_where_gt", on_tx("SELECT tx_id, amount FROM tx WHERE amount > 53000"))
def where_gt(spark, sf_dir):
    return R.where_gt(ledger(spark, sf_dir, ("tx_id", "amount")), "amount", 53000)


@query(
    "p10_where_ge",
    on_tx("SELECT tx_id, amount FROM tx WHERE amount >= (SELECT max(amount) / 2 FROM tx)"),
)
def where_ge(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "amount"))
    middle = rows.agg(F.max("amount") / 2).scalar()
    return R.where_gt(rows, "amount", middle, or_equal=True)


@query(
    "p11_high_value",
    on_tx(
        """SELECT tx_id, amount FROM f
        WHERE amount > (SELECT quantile_cont(amount, 0.75) FROM f)""",
        "f AS (SELECT * FROM tx WHERE fraud_type <> 'none')",
    ),
)
def high_value(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "amount", "labelled")).filter("labelled")
    return R.high_value(rows.drop("labelled"), "amount")


@query(
    "p12_split_label_fraud",
    on_tx("SELECT tx_id, fraud_type FROM tx WHERE fraud_type <> 'none'"),
)
def split_label_fraud(spark, sf_dir):
    return R.split_label(ledger(spark, sf_dir, ("tx_id", "fraud_type")), "fraud")


@query(
    "p12_split_label_nonfraud",
    on_tx("SELECT tx_id, fraud_type FROM tx WHERE fraud_type = 'none'"),
)
def split_label_nonfraud(spark, sf_dir):
    return R.split_label(ledger(spark, sf_dir, ("tx_id", "fraud_type")), "non-fraud")


@query(
    "p13_normalise",
    on_tx(
        f"""SELECT tx_id, coalesce(s.new, category) AS category
        FROM tx LEFT JOIN (VALUES {pairs(SYNONYMS)}) s(old, new) ON category = s.old"""
    ),
)
def normalise(spark, sf_dir):
    return R.normalise(ledger(spark, sf_dir, ("tx_id", "category")), "category", SYNONYMS)


@query(
    "p14_case_when",
    on_tx(
        """SELECT tx_id,
          CASE WHEN tx_type = 'income' OR category = 'Income' THEN bank_from ELSE bank_to END AS bank_to,
          CASE WHEN tx_type = 'spending' THEN bank_to ELSE bank_from END AS bank_from
        FROM tx"""
    ),
)
def case_when(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "tx_type", "category", "bank_to", "bank_from"))
    earned = (F.col("tx_type") == "income") | (F.col("category") == "Income")
    rules = {
        "bank_to": F.when(earned, F.col("bank_from")).otherwise(F.col("bank_to")),
        "bank_from": F.when(F.col("tx_type") == "spending", F.col("bank_to")).otherwise(
            F.col("bank_from")
        ),
    }
    return R.case_when(rows, rules).drop("tx_type", "category")


@query(
    "p15_classify_flow",
    on_tx(
        f"""SELECT tx_id, CASE WHEN category IN {texts(S.INCOME_CATEGORIES)}
               OR contains(description, '{INCOMING_TEXT}') THEN 'income' ELSE 'spending' END AS tx_type
        FROM tx"""
    ),
)
def classify_flow(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category", "description"))
    return R.classify_flow(rows, INCOMING_TEXT).select("tx_id", "tx_type")


@query(
    "p16_relabel_flag",
    on_tx(
        """SELECT customer_id, CASE WHEN max(CASE WHEN fraud_type <> 'none' THEN 1 ELSE 0 END) = 1
               THEN 'scammed' ELSE 'not-scammed' END AS customer_scammed
        FROM tx GROUP BY customer_id"""
    ),
)
def relabel_flag(spark, sf_dir):
    return R.relabel_flag(customer_flags(spark, sf_dir))


@query(
    "p17_adjust_amount",
    on_tx(
        """SELECT tx_id, amount, CASE WHEN amount > 2 THEN amount * f ELSE amount + 4 END AS new_amount
        FROM s""",
        f"s AS (SELECT tx_id, amount / 20000 AS amount, {between(1, 2, 'factor', 'customer_id')} AS f FROM tx)",
    ),
)
def adjust_amount(spark, sf_dir):
    rows = R.rescale(ledger(spark, sf_dir, ("tx_id", "customer_id", "amount")), "amount", 20000)
    rows = rows.withColumn("factor_increase", draw_uniform(1.0, 2.0, "customer_id", salt="factor"))
    return R.adjust_amount(rows).select("tx_id", "amount", "new_amount")


@query(
    "p18_scale_by_entity",
    on_tx(
        f"""SELECT tx_id, customer_id, amount * {between(0.1, 0.5, 'scale', 'customer_id')} AS amount
        FROM tx"""
    ),
)
def scale_by_entity(spark, sf_dir):
    return R.scale_by_entity(ledger(spark, sf_dir, ("tx_id", "customer_id", "amount")))


