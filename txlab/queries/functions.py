"""F: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab.functions import calendar as cal
from txlab.functions import columns as C
from txlab.queries.oracle import exact_sum, last_friday, on_tx, texts
from txlab.queries.registry import query
from txlab.sources.ledger import INCOMING_TEXT, ledger, table

DESCRIPTIONS = ("red ring", "blue bolt", "old gear")


@query(
    "f1_contains",
    on_tx(f"SELECT tx_id, contains(description, '{INCOMING_TEXT}') AS found FROM tx"),
)
def contains(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "description"))
    return rows.select("tx_id", C.contains_text("description", INCOMING_TEXT).alias("found"))


@query(
    "f2_in_list",
    on_tx(f"SELECT tx_id, description IN {texts(DESCRIPTIONS)} AS listed FROM tx"),
)
def in_list(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "description"))
    return rows.select("tx_id", F.col("description").isin(*DESCRIPTIONS).alias("listed"))


@query(
    "f3_parse_datetime",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS at,
           CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def parse_datetime(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    written = orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS").alias("at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    return written.select(
        "o_orderkey",
        cal.parse_timestamp("at", "yyyy-MM-dd HH:mm:ss.SSSSSSSSS").alias("at"),
        cal.parse_date("day", "yyyy-MM-dd").alias("day"),
    )


@query(
    "f4_month",
    on_tx(
        """SELECT tx_id, CAST(month(tx_date) AS INT) AS month,
               CAST(date_trunc('month', tx_date) AS DATE) AS month_start FROM tx"""
    ),
)
def month(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "tx_date"))
    return rows.select(
        "tx_id",
        cal.month_number("tx_date").alias("month"),
        cal.month_start("tx_date").alias("month_start"),
    )


@query(
    "f5_month_bounds",
    on_tx(
        """SELECT tx_id, CAST(date_trunc('month', tx_date) AS DATE) AS first_day,
               last_day(tx_date) AS last_day FROM tx"""
    ),
)
def month_bounds(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "tx_date"))
    return rows.select(
        "tx_id",
        cal.month_start("tx_date").alias("first_day"),
        cal.month_end("tx_date").alias("last_day"),
    )


@query(
    "f6_last_friday",
    on_tx(f"SELECT tx_id, CAST({last_friday('tx_date')} AS DATE) AS friday FROM tx"),
)
def friday(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "tx_date"))
    return rows.select("tx_id", cal.last_friday("tx_date").alias("friday"))


@query(
    "f7_month_frames",
    on_tx(
        """SELECT customer_id, CAST(greatest(month, day) AS DATE) AS month_start,
               last_day(month) AS month_end
        FROM (SELECT customer_id, min(tx_date) AS day,
                     unnest([date_trunc('month', min(tx_date)) + to_months(CAST(i AS INT)) FOR i IN range(3)])
                       AS month
              FROM tx GROUP BY customer_id)"""
    ),
)
def frames(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("customer_id", "tx_date"))
    first = rows.groupBy("customer_id").agg(F.min("tx_date").alias("day"))
    return first.select(
        "customer_id", F.explode(cal.month_frames("day", 3)).alias("frame")
    ).select(
        "customer_id",
        F.col("frame.start").alias("month_start"),
        F.col("frame.end").alias("month_end"),
    )


@query(
    "f8_day_sequence",
    """SELECT o_custkey AS customer_id,
           CAST(unnest(generate_series(last_day(min(o_orderdate)) - 3,
                last_day(min(o_orderdate)) + 3, INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders GROUP BY o_custkey""",
)
def day_sequence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        cal.month_end(F.min(F.col("o_orderdate").cast("date"))).alias("last")
    )
    days = cal.days_between(F.date_sub("last", 3), F.date_add("last", 3))
    return last.select("customer_id", F.explode(days).alias("day"))


@query(
    "f9_arithmetic",
    on_tx(
        """SELECT tx_id, amount / 100 AS pounds, amount * 1.5::DOUBLE AS scaled, amount + 4 AS added,
               customer_id // 3 AS third, CAST(floor(customer_id / 1.2::DOUBLE) AS BIGINT) AS most
        FROM tx"""
    ),
)
def arithmetic(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "customer_id", "amount"))
    return rows.select(
        "tx_id",
        (F.col("amount") / 100).alias("pounds"),
        (F.col("amount") * 1.5).alias("scaled"),
        (F.col("amount") + 4).alias("added"),
        F.expr("customer_id div 3").alias("third"),
        F.floor(F.col("customer_id") / F.lit(1.2)).alias("most"),
    )


@query(
    "f10_half_even",
    """SELECT l_quantity / 2 AS half, round_even(l_quantity / 2, 0) AS whole, count(*) AS n
    FROM lineitem GROUP BY l_quantity""",
)
def half_even(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    counts = rows.groupBy((F.col("l_quantity") / 2).alias("half")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("half", C.half_even("half").alias("whole"), "n")


@query(
    "f11_spent_text",
    on_tx(
        f"""SELECT category, format('Spent: £{{:,}} ', CAST(round_even({exact_sum('amount')}, 0) AS BIGINT))
               AS text FROM tx WHERE tx_type = 'spending' GROUP BY category"""
    ),
)
def spent_text(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("category", "tx_type", "amount")).filter("tx_type = 'spending'")
    totals = rows.groupBy("category").agg(C.half_even(C.money_sum("amount")).alias("spent"))
    return totals.select("category", C.spent_text("spent").alias("text"))


@query("f12_null_test", on_tx("SELECT tx_id, bank_to IS NULL AS missing FROM tx"))
def null_test(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "bank_to"))
    return rows.select("tx_id", F.col("bank_to").isNull().alias("missing"))


@query(
    "f13_list_index",
    on_tx(
        """SELECT tx_id, CAST(len(words) AS INT) AS words, words[1] AS first, words[3] AS third
        FROM (SELECT tx_id, string_split(description, ' ') AS words FROM tx)"""
    ),
)
def list_index(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "description"))
    words = F.split("description", " ")
    return rows.select(
        "tx_id",
        F.size(words).alias("words"),
        F.try_element_at(words, F.lit(1)).alias("first"),
        F.try_element_at(words, F.lit(3)).alias("third"),
    )


@query(
    "f14_conditional",
    on_tx(
        """SELECT tx_id, CASE WHEN amount > 90000 THEN 'high' WHEN amount > 30000 THEN 'middle'
               ELSE category END AS band FROM tx"""
    ),
)
def conditional(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "amount", "category"))
    rules = [(F.col("amount") > 90000, "high"), (F.col("amount") > 30000, "middle")]
    return rows.select("tx_id", C.case_when(rules, F.col("category")).alias("band"))
