"""J: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions.draws import draw_uniform
from txlab.operators import aggregates as A
from txlab.operators import joins as J
from txlab.operators import sampling as R
from txlab.queries.oracle import between, exact_sum, index, on_tx, pairs, rank, texts
from txlab.queries.registry import query
from txlab.sources.ledger import ledger, table
from txlab.sources.staging import stage

FRAUD = "f AS (SELECT * FROM tx WHERE fraud_type <> 'none')"
MAPPING = {
    "Romance": ["Groceries", "Housing"],
    "Purchase": ["Groceries", "Cash Withdrawal"],
    "Impersonation": ["Utilities"],
}


def labelled(spark, sf_dir, columns):
    """Ledger rows with a fraud label, filtered where the files are read."""
    rows = ledger(spark, sf_dir, (*columns, "labelled"))
    return rows.filter("labelled").drop("labelled")


@query(
    "j1_factor",
    on_tx(
        f"""SELECT tx_id, customer_id, {between(1, 2, 'factor', 'customer_id')} AS factor_increase
        FROM tx"""
    ),
)
def factor(spark, sf_dir):
    tx = ledger(spark, sf_dir, ("tx_id", "customer_id"))
    factors = tx.select("customer_id").distinct()
    factors = factors.withColumn(
        "factor_increase", draw_uniform(1.0, 2.0, "customer_id", salt="factor")
    )
    return J.join_factor(tx, factors)


@query(
    "j2_case_value",
    on_tx(
        f"""SELECT tx_id, case_id, case_value FROM tx LEFT JOIN
          (SELECT case_id, {exact_sum('amount')} AS case_value FROM f GROUP BY case_id) USING (case_id)""",
        FRAUD,
    ),
)
def case_value(spark, sf_dir):
    totals = A.group_totals(labelled(spark, sf_dir, ("case_id", "amount")), value="amount")
    return J.attach_total(ledger(spark, sf_dir, ("tx_id", "case_id")), totals)


@query("j3_remove_rows", on_tx("SELECT tx_id, amount FROM tx WHERE fraud_type = 'none'"))
def remove_rows(spark, sf_dir):
    removed = labelled(spark, sf_dir, ("tx_id",))
    tx = ledger(spark, sf_dir, ("tx_id", "amount"))
    return J.remove_rows(tx, removed.unionByName(removed), ["tx_id"])


@query(
    "j4_keep_customers",
    on_tx(
        "SELECT tx_id, customer_id FROM tx WHERE customer_id IN (SELECT customer_id FROM f)", FRAUD
    ),
)
def keep_customers(spark, sf_dir):
    tx = ledger(spark, sf_dir, ("tx_id", "customer_id"))
    return J.keep_customers(tx, labelled(spark, sf_dir, ("customer_id",)))


@query(
    "j4_exclude_customers",
    on_tx(
        "SELECT tx_id, customer_id FROM tx WHERE customer_id NOT IN (SELECT customer_id FROM f)",
        FRAUD,
    ),
)
def exclude_customers(spark, sf_dir):
    tx = ledger(spark, sf_dir, ("tx_id", "customer_id"))
    return J.exclude_customers(tx, labelled(spark, sf_dir, ("customer_id",)))


@query(
    "j5_keep_on_dates",
    on_tx(
        """SELECT tx_id, customer_id, tx_date FROM tx
        WHERE (customer_id, tx_date) IN (SELECT customer_id, tx_date FROM f)""",
        FRAUD,
    ),
)
def keep_on_dates(spark, sf_dir):
    tx = ledger(spark, sf_dir, ("tx_id", "customer_id", "tx_date"))
    return J.keep_on_dates(tx, labelled(spark, sf_dir, ("customer_id", "tx_date")))


@query(
    "j6_merge_common",
    on_tx(
        """SELECT coalesce(a.tx_id, b.tx_id) AS tx_id, coalesce(a.bank_to, b.bank_to) AS bank_to,
               a.amount, b.description
        FROM tx a
        FULL JOIN (SELECT tx_id, CASE WHEN tx_type = 'income' THEN 'own' ELSE bank_to END AS bank_to, description
                   FROM tx) b
          ON a.tx_id IS NOT DISTINCT FROM b.tx_id AND a.bank_to IS NOT DISTINCT FROM b.bank_to"""
    ),
)
def merge_common(spark, sf_dir):
    left = ledger(spark, sf_dir, ("tx_id", "bank_to", "amount"))
    right = ledger(spark, sf_dir, ("tx_id", "tx_type", "bank_to", "description"))
    own = F.when(F.col("tx_type") == "income", "own").otherwise(F.col("bank_to"))
    return J.merge_common(left, right.withColumn("bank_to", own).drop("tx_type"))


@query(
    "j6_merge_matched",
    on_tx(
        """SELECT coalesce(a.bank_to, b.bank_to) AS bank_to, coalesce(a.category, b.category) AS category,
               a.amount, b.description
        FROM (SELECT bank_to, category, amount, row_number() OVER (
                PARTITION BY bank_to, category ORDER BY amount NULLS FIRST) AS i FROM tx WHERE customer_id % 3 <> 0) a
        FULL JOIN (SELECT bank_to, category, description, row_number() OVER (
                PARTITION BY bank_to, category ORDER BY description NULLS FIRST) AS i FROM tx WHERE customer_id % 3 <> 1) b
          ON a.bank_to IS NOT DISTINCT FROM b.bank_to AND a.category IS NOT DISTINCT FROM b.category AND a.i = b.i"""
    ),
)
def merge_matched(spark, sf_dir):
    rows = stage(ledger(spark, sf_dir, ("customer_id", "bank_to", "category", "amount", "description")))
    left = rows.filter("customer_id % 3 <> 0").select("bank_to", "category", "amount")
    return J.merge_matched(left, rows.filter("customer_id % 3 <> 1").select("bank_to", "category", "description"))


@query(
    "j7_lookup",
    on_tx(
        f"""SELECT tx_id, tx.category, cap FROM tx
        JOIN (VALUES {pairs(S.MONTHLY_CAPS)}) caps(category, cap) ON tx.category = caps.category"""
    ),
)
def lookup(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "category"))
    return J.lookup(rows, "category", S.MONTHLY_CAPS, "cap")


_MAPPED = ", ".join(f"('{g}', '{c}')" for g, members in MAPPING.items() for c in members)


@query(
    "j8_map_categories",
    on_tx(
        f"""SELECT DISTINCT subcategory, description, tx.category, m.fraud_type
        FROM tx JOIN (VALUES {_MAPPED}) m(fraud_type, category) ON tx.category = m.category"""
    ),
)
def map_categories(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("category", "subcategory", "description")).distinct()
    return J.map_categories(rows, MAPPING)


@query(
    "j9_random_lookup",
    on_tx(
        f"""SELECT tx_id, f.fraud_type, p.description, p.category
        FROM f JOIN (SELECT fraud_type, count(*) AS n FROM pool GROUP BY fraud_type) s USING (fraud_type)
          JOIN pool p ON p.fraud_type = f.fraud_type AND p.pos = {index('s.n', 'describe', 'tx_id')}""",
        FRAUD,
        f"""pool AS (SELECT *, {rank('pool', 'key', 'fraud_type')} - 1 AS pos
          FROM (SELECT DISTINCT fraud_type, description, category,
                       concat(description, '|', category) AS key FROM f))""",
    ),
)
def random_lookup(spark, sf_dir):
    rows = stage(labelled(spark, sf_dir, ("tx_id", "fraud_type", "description", "category")))
    members = rows.select("fraud_type", "description", "category").distinct()
    members = members.withColumn("key", F.concat("description", F.lit("|"), "category"))
    pool = R.index_pool(stage(members), ["fraud_type"], ["key"])
    cases = rows.select("tx_id", "fraud_type")
    return R.pick(cases, pool, ["tx_id"], "describe", ["description", "category"])


@query(
    "j10_zip",
    on_tx(
        f"""SELECT position, tx_id, amount, order_id, customer_id
        FROM (SELECT tx_id, amount, {rank('zip', 'tx_id')} AS position FROM tx)
        FULL JOIN (SELECT o_orderkey AS order_id, o_custkey AS customer_id, {rank('zip', 'o_orderkey')} AS position
                   FROM orders) USING (position)""",
    ),
)
def zip_columns(spark, sf_dir):
    left = ledger(spark, sf_dir, ("tx_id", "amount"))
    right = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return J.zip_columns(left, right, ["tx_id"], ["order_id"], how="full")


@query(
    "j11_skeleton",
    on_tx(
        """SELECT customer_id, CAST(m AS DATE) AS month_start, CAST(last_day(CAST(m AS DATE)) AS DATE) AS month_end
        FROM (SELECT customer_id, unnest(generate_series(
                CAST(date_trunc('month', min(tx_date)) AS TIMESTAMP),
                CAST(date_trunc('month', max(tx_date)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
              FROM tx GROUP BY customer_id)"""
    ),
)
def skeleton(spark, sf_dir):
    return J.skeleton(ledger(spark, sf_dir, ("customer_id", "tx_date")), ["customer_id"])


CARRIED = f"""bounds AS (SELECT min(date_trunc('month', tx_date)) AS first,
    date_diff('month', min(date_trunc('month', tx_date)), max(date_trunc('month', tx_date))) AS later
  FROM tx),
carried AS (
  SELECT tx.* EXCLUDE (tx_id, tx_date),
         CASE WHEN i = 0 THEN tx_id ELSE concat(tx_id, '#', i) END AS tx_id,
         CAST(tx_date + to_months(CAST(i AS INT)) AS DATE) AS tx_date
  FROM tx, bounds, range(bounds.later + 1) ahead(i)
  WHERE category IN {texts(S.BILL_CATEGORIES)} AND date_trunc('month', tx_date) = first
  UNION ALL BY NAME
  SELECT * FROM tx WHERE category NOT IN {texts(S.BILL_CATEGORIES)} OR category IS NULL OR tx_date IS NULL)"""


@query(
    "j12_carry_forward",
    on_tx("SELECT tx_id, customer_id, tx_date, category, amount FROM carried", CARRIED),
)
def carry_forward(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "tx_date", "category", "amount"))
    return J.carry_forward(stage(rows), S.BILL_CATEGORIES)
