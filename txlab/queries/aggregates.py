"""A, T, U: aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab.functions.columns import adjusted_amount
from txlab.functions.draws import draw_uniform
from txlab.operators import aggregates as A
from txlab.operators import joins as J
from txlab.operators import quantiles as Q
from txlab.plans.banks import vary_amounts
from txlab.queries.joins import FRAUD, labelled
from txlab.queries.oracle import between, exact_mean, exact_sum, on_tx, u
from txlab.queries.registry import query
from txlab.sources.ledger import ledger, table
from txlab.sources.staging import stage
from txlab.sources.views import customer_flags

_FLOWS = """SELECT bank_from, bank_to, count(*) AS n FROM tx
  WHERE bank_from IS NOT NULL AND bank_to IS NOT NULL {also} GROUP BY bank_from, bank_to"""


@query("a1_bank_flows_all", on_tx(_FLOWS.format(also="")))
def bank_flows_all(spark, sf_dir):
    return A.bank_flows(ledger(spark, sf_dir, ("bank_from", "bank_to")))


@query("a1_bank_flows_fraud", on_tx(_FLOWS.format(also="AND fraud_type <> 'none'")))
def bank_flows_fraud(spark, sf_dir):
    return A.bank_flows(labelled(spark, sf_dir, ("bank_from", "bank_to", "fraud_type")), "fraud")


@query("a1_bank_flows_nonfraud", on_tx(_FLOWS.format(also="AND fraud_type = 'none'")))
def bank_flows_nonfraud(spark, sf_dir):
    return A.bank_flows(ledger(spark, sf_dir, ("bank_from", "bank_to", "fraud_type")), "non-fraud")


_AVERAGE_COLUMNS = ("category", "tx_type", "fraud_type", "amount")
AVERAGE = f"""SELECT category, round_even({exact_mean('amount')}, 0) AS average FROM tx
  WHERE category <> 'Investment' AND {{also}} GROUP BY category ORDER BY 2 DESC"""
NONFRAUD = "fraud_type = 'none' AND tx_type <> 'income' AND category <> 'Housing'"


@query("a2_category_average_fraud", on_tx(AVERAGE.format(also="fraud_type <> 'none'")))
def category_average_fraud(spark, sf_dir):
    return A.category_average(labelled(spark, sf_dir, _AVERAGE_COLUMNS), "fraud")


@query("a2_category_average_nonfraud", on_tx(AVERAGE.format(also=NONFRAUD)))
def category_average_nonfraud(spark, sf_dir):
    return A.category_average(ledger(spark, sf_dir, _AVERAGE_COLUMNS), "non-fraud")


_SPENT = f"""SELECT round_even({exact_sum('amount')}, 0) AS spent
  FROM tx WHERE tx_type = 'spending' AND {{also}}"""


@query("a3_spend_total_fraud", on_tx(_SPENT.format(also="fraud_type <> 'none'")))
def spend_total_fraud(spark, sf_dir):
    return A.spend_total(labelled(spark, sf_dir, ("tx_type", "fraud_type", "amount")), "fraud")


@query("a3_spend_total_nonfraud", on_tx(_SPENT.format(also="fraud_type = 'none'")))
def spend_total_nonfraud(spark, sf_dir):
    return A.spend_total(ledger(spark, sf_dir, ("tx_type", "fraud_type", "amount")), "non-fraud")


@query(
    "a3_spend_total_varied",
    on_tx(
        f"""SELECT round_even(sum(CASE WHEN amount > 2 THEN amount * {between(1, 2, 'factor', 'customer_id')}
              ELSE amount + 4 END), 0) AS spent FROM tx WHERE tx_type = 'spending' AND fraud_type = 'none'"""
    ),
)
def spend_total_varied(spark, sf_dir):
    """The total of amounts with many places, added as they are."""
    rows = ledger(spark, sf_dir, ("customer_id", "tx_type", "fraud_type", "amount"))
    return A.spend_total(vary_amounts(rows), "non-fraud", amount="new_amount")


FLAGS = """flags AS (SELECT customer_id,
    max(CASE WHEN fraud_type <> 'none' THEN 1 ELSE 0 END) AS customer_scammed
  FROM tx GROUP BY customer_id)"""
COUNTS = """SELECT CASE WHEN customer_scammed = 1 THEN 'scammed' ELSE 'not-scammed' END
    AS customer_scammed, count(*) AS customers
  FROM flags GROUP BY flags.customer_scammed ORDER BY 1 DESC"""


@query("a4_scammed_counts", on_tx(COUNTS, FLAGS))
def scammed_counts(spark, sf_dir):
    return A.scammed_counts(customer_flags(spark, sf_dir))


@query(
    "a5_counts_by",
    on_tx(
        """SELECT category, count(description) AS description, count(bank_to) AS bank_to,
               count(amount) AS amount FROM tx GROUP BY category"""
    ),
)
def counts_by(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("category", "description", "bank_to", "amount"))
    return A.counts_by(rows, "category")


@query(
    "a6_case_value",
    on_tx(
        f"SELECT case_id, {exact_sum('amount')} AS case_value FROM f WHERE amount > 1 GROUP BY case_id",
        FRAUD,
    ),
)
def case_value(spark, sf_dir):
    rows = labelled(spark, sf_dir, ("case_id", "amount")).filter("amount > 1")
    return A.group_totals(rows, value="amount")


VARIED = f"""varied AS (SELECT customer_id, CASE WHEN amount > 2
    THEN amount * {between(1, 2, 'factor', 'customer_id')} ELSE amount + 4 END AS new_amount FROM tx)"""


def varied(spark, sf_dir):
    """Every row's amount with its customer's factor."""
    rows = ledger(spark, sf_dir, ("customer_id", "amount"))
    factor = draw_uniform(1.0, 2.0, "customer_id", salt="factor")
    return rows.select("customer_id", adjusted_amount("amount", factor).alias("new_amount"))


@query(
    "a7_customer_mean",
    on_tx(
        """SELECT customer_id, round(avg(new_amount), 4) AS mean_amount
        FROM varied GROUP BY customer_id""",
        VARIED,
    ),
)
def customer_mean(spark, sf_dir):
    means = A.customer_mean(varied(spark, sf_dir))
    return means.withColumn("mean_amount", F.round("mean_amount", 4))


@query(
    "a8_histogram",
    on_tx(
        """SELECT bin, round(low + bin * width, 4) AS bin_from,
               round(low + (bin + 1) * width, 4) AS bin_to, count(m) AS n
        FROM ends, range(20) bins(bin) LEFT JOIN (
          SELECT m, least(floor((m - low) / width), 19) AS place FROM means, ends) ON place = bin
        GROUP BY bin, low, width""",
        VARIED,
        "means AS (SELECT avg(new_amount) AS m FROM varied GROUP BY customer_id)",
        "ends AS (SELECT min(m) AS low, (max(m) - min(m)) / 20 AS width FROM means)",
    ),
)
def histogram(spark, sf_dir):
    bins = Q.histogram(stage(A.customer_mean(varied(spark, sf_dir))), "mean_amount", 20)
    return bins.withColumns({c: F.round(c, 4) for c in ("bin_from", "bin_to")})


@query(
    "a9_quantiles_fraud",
    on_tx(
        """SELECT q, round(CASE q WHEN 0.25 THEN v[1] WHEN 0.5 THEN v[2] ELSE v[3] END, 4) AS value
        FROM (SELECT quantile_cont(amount, [0.25, 0.5, 0.75]) AS v FROM f),
             (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) t(q)""",
        FRAUD,
    ),
)
def quantiles_fraud(spark, sf_dir):
    result = Q.exact_quantiles(labelled(spark, sf_dir, ("amount",)), "amount", [0.25, 0.5, 0.75])
    return result.withColumn("value", F.round("value", 4))


@query(
    "a9_quantiles_income",
    on_tx(
        """SELECT q, round(CASE q WHEN 0.25 THEN v[1] WHEN 0.5 THEN v[2] ELSE v[3] END, 4) AS value
        FROM (SELECT quantile_cont(amount, [0.25, 0.5, 0.9]) AS v FROM tx WHERE category = 'Income'),
             (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) t(q)"""
    ),
)
def quantiles_income(spark, sf_dir):
    income = ledger(spark, sf_dir, ("amount", "category")).filter("category = 'Income'")
    result = Q.exact_quantiles(stage(income), "amount", [0.25, 0.5, 0.9], written=True)
    return result.withColumn("value", F.round("value", 4))


@query("a10_range", on_tx("SELECT min(amount) AS min, max(amount) AS max FROM tx"))
def value_range(spark, sf_dir):
    return Q.value_range(ledger(spark, sf_dir, ("amount",)), "amount")


@query(
    "a11_distinct_count",
    on_tx(
        """SELECT count(DISTINCT customer_id) AS customer_id, count(DISTINCT month(tx_date)) AS month,
               count(DISTINCT tx_date) AS tx_date, count(DISTINCT bank_to) + 1 AS bank_to FROM tx"""
    ),
)
def distinct_count(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("customer_id", "tx_date", "bank_to"))
    rows = rows.withColumn("month", F.month("tx_date"))
    return A.distinct_counts(rows, ["customer_id", "month", "tx_date", "bank_to"])


@query("a12_distinct_values", on_tx("SELECT DISTINCT category, description FROM tx"))
def distinct_values(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("category", "description"))
    return A.distinct_values(rows, "category", "description")


@query(
    "a13_dedupe",
    on_tx(
        """SELECT category, subcategory, arg_min(description, tx_id) AS description,
               min(tx_id) AS tx_id FROM tx GROUP BY category, subcategory"""
    ),
)
def dedupe(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("category", "subcategory", "description", "tx_id"))
    return A.drop_duplicates(rows, ["category", "subcategory"], order=["tx_id"])


@query(
    "a13_dedupe_keys",
    on_tx("SELECT DISTINCT customer_id, fraud_type <> 'none' AS labelled FROM tx"),
)
def dedupe_keys(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("customer_id", "labelled"))
    return A.drop_duplicates(rows, ["customer_id", "labelled"])


@query(
    "a14_mean_outflow",
    on_tx(
        f"""SELECT bank_from, avg(n) / 10000 AS mean_outflow
        FROM ({_FLOWS.format(also="")}) GROUP BY bank_from"""
    ),
)
def mean_outflow(spark, sf_dir):
    return A.mean_outflow(bank_flows_all(spark, sf_dir))


@query(
    "a15_group_lists",
    on_tx(
        f"""SELECT fraud_type, description, category,
               row_number() OVER (PARTITION BY fraud_type
                 ORDER BY {u('list', 'description', 'category')}, description, category) AS position
        FROM (SELECT DISTINCT fraud_type, description, category FROM f)""",
        FRAUD,
    ),
)
def group_lists(spark, sf_dir):
    rows = labelled(spark, sf_dir, ("fraud_type", "description", "category"))
    return A.group_lists(stage(rows), "fraud_type", ["description", "category"])


@query(
    "a16_first_in_group",
    on_tx(
        """SELECT customer_id, arg_min(amount, (tx_date, tx_id)) AS amount,
               arg_min(bank_from, (tx_date, tx_id)) AS bank_from
        FROM tx WHERE category = 'Income' GROUP BY customer_id"""
    ),
)
def first_in_group(spark, sf_dir):
    rows = ledger(
        spark, sf_dir, ("customer_id", "tx_id", "tx_date", "category", "amount", "bank_from")
    )
    return A.first_in_group(
        rows,
        ["customer_id"],
        F.col("category") == "Income",
        ["tx_date", "tx_id"],
        ["amount", "bank_from"],
    )


@query(
    "a17_empty_group",
    on_tx(
        """SELECT subcategory, count(tx_id) AS n, count(tx_id) = 0 AS is_empty
        FROM (SELECT DISTINCT description AS subcategory FROM tx UNION SELECT DISTINCT subcategory FROM tx)
        LEFT JOIN tx USING (subcategory) GROUP BY subcategory"""
    ),
)
def empty_group(spark, sf_dir):
    # Texts and subcategories as groups: no row has a text as its subcategory.
    rows = ledger(spark, sf_dir, ("subcategory", "description"))
    groups = rows.select("subcategory").union(rows.select("description"))
    return A.empty_groups(groups, rows, "subcategory")


@query(
    "t1_sort",
    on_tx(
        """SELECT description, count(*) AS n FROM tx GROUP BY description
        ORDER BY n DESC, description"""
    ),
)
def sort_desc(spark, sf_dir):
    counts = ledger(spark, sf_dir, ("description",)).groupBy("description")
    return A.sort_desc(counts.agg(F.count(F.lit(1)).alias("n")), "n", "description")


@query(
    "t2_sorted_distinct",
    on_tx("SELECT DISTINCT bank_to FROM tx WHERE bank_to IS NOT NULL ORDER BY bank_to"),
)
def sorted_distinct(spark, sf_dir):
    return A.sorted_distinct(ledger(spark, sf_dir, ("bank_to",)), "bank_to")


@query(
    "u1_union",
    on_tx(
        """SELECT tx_id, amount FROM tx
        UNION ALL SELECT o_orderkey::VARCHAR, o_totalprice FROM orders"""
    ),
)
def union_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("amount"), F.col("o_orderkey").cast("string").alias("tx_id")
    )
    return J.union_all(ledger(spark, sf_dir, ("tx_id", "amount")), orders)


@query(
    "u2_union_relaxed",
    on_tx(
        """SELECT tx_id, CAST(customer_id AS VARCHAR) AS customer_id, amount, NULL AS tx_type
        FROM tx
        UNION ALL
        SELECT tx_id, concat('c', customer_id), CAST(floor(amount) AS INT), tx_type FROM tx"""
    ),
)
def union_relaxed(spark, sf_dir):
    left = ledger(spark, sf_dir, ("tx_id", "customer_id", "amount"))
    right = (
        ledger(spark, sf_dir, ("tx_id", "customer_id", "amount", "tx_type"))
        .select(
            "tx_id",
            F.concat(F.lit("c"), F.col("customer_id").cast("string")).alias("customer_id"),
            F.floor("amount").cast("int").alias("amount"),
            "tx_type",
        )
    )
    return J.union_relaxed(left, right)


@query(
    "u3_except",
    on_tx(
        """SELECT description FROM tx WHERE fraud_type = 'none'
        EXCEPT SELECT description FROM tx WHERE fraud_type <> 'none'"""
    ),
)
def values_missing_from(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("description", "fraud_type"))
    return J.values_missing_from(
        rows.filter("fraud_type = 'none'"), rows.filter("fraud_type <> 'none'"), "description"
    )
