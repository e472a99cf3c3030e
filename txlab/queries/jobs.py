"""K: composite jobs.

A job reads its ledger several times, so the view is written once first, as a
user's ledger would be.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.operators.joins import map_categories
from txlab.plans import banks as B
from txlab.plans import cases as C
from txlab.plans import catalogue as K
from txlab.plans import labels as L
from txlab.plans import months as M
from txlab.plans import report as P
from txlab.queries.aggregates import AVERAGE, COUNTS, FLAGS, NONFRAUD
from txlab.queries.joins import CARRIED, FRAUD, labelled
from txlab.queries.oracle import (
    between,
    choice,
    distinct_position,
    exact_sum,
    index,
    integer,
    last_friday,
    on_tx,
    pairs,
    rank,
    text,
    texts,
    u,
)
from txlab.queries.registry import query
from txlab.queries.sampling import CATALOGUE
from txlab.sources import views
from txlab.sources.ledger import CATEGORY_OF_TYPE, INCOMING_TEXT, ledger
from txlab.sources.staging import stage


# K1 ------------------------------------------------------------------------


@query(
    "k1_expand",
    on_tx(
        f"""SELECT tx_id, category, subcategory, description,
               CAST(round_even(CAST(least(greatest(amount, "min"), "max") AS DECIMAL(28, 10)), 2) AS DOUBLE) AS amount,
               'non-fraud' AS origin
        FROM (SELECT tx_id, amount, {index('(SELECT count(*) FROM catalogue)', 'expand', 'tx_id')} AS pos
              FROM tx WHERE amount >= 1) t JOIN pool p USING (pos)""",
        CATALOGUE,
        f"""pool AS (SELECT *, row_number() OVER (
              ORDER BY {u('catalogue', 'category', 'subcategory', 'description')},
                category, subcategory, description) - 1 AS pos FROM catalogue)""",
    ),
)
def expand(spark, sf_dir):
    rows = ledger(spark, sf_dir, ("tx_id", "amount"))
    return K.expand_catalogue(views.catalogue(spark, sf_dir), rows)


# K2 to K5 ------------------------------------------------------------------

TEXT_SYNONYMS = {"Investment": "Savings", "Groceries": "Shopping"}


@query(
    "k2_describe",
    on_tx(
        f"""SELECT f.tx_id AS case_key, f.case_id, f.fraud_type, f.amount / 100 AS transaction_value,
               p.description, coalesce(syn.new, p.category) AS category
        FROM f JOIN (SELECT fraud_type, count(*) AS n FROM pool GROUP BY fraud_type) s USING (fraud_type)
          JOIN pool p ON p.fraud_type = f.fraud_type AND p.pos = {index('s.n', 'describe', 'f.tx_id')}
          LEFT JOIN (VALUES {pairs(TEXT_SYNONYMS)}) syn(old, new) ON p.category = syn.old""",
        FRAUD,
        f"""pool AS (SELECT *, row_number() OVER (PARTITION BY fraud_type
              ORDER BY {u('texts', 'description', 'category')}, description, category) - 1 AS pos
            FROM (SELECT DISTINCT fraud_type, description, category FROM f))""",
    ),
)
def describe(spark, sf_dir):
    cases = stage(views.cases(spark, sf_dir))
    pool = cases.select("fraud_type", "description", "category").distinct()
    bare = cases.drop("description", "category")
    return C.describe_cases(bare, pool, synonyms=TEXT_SYNONYMS)


BLEND_MAPPING = {
    "Investment": ["Investment"],
    "Romance": ["Groceries", "Housing"],
    "Impersonation": ["Utilities"],
}
_BLEND_CATEGORIES = texts([c for members in BLEND_MAPPING.values() for c in members])
_MAPPED = ", ".join(f"('{g}', '{c}')" for g, members in BLEND_MAPPING.items() for c in members)
_MAPPED_KEY = "fraud_type, category, subcategory, description"
BLENDED = (
    """cases AS (SELECT tx_id AS case_key, case_id, amount AS transaction_value, fraud_type,
       category, description FROM tx
  WHERE fraud_type <> 'none')""",
    f"""mapped AS (SELECT *, row_number() OVER (PARTITION BY category
         ORDER BY {u('mapped', 'fraud_type', 'category', 'subcategory', 'description')}, {_MAPPED_KEY}) - 1 AS pos,
       count(*) OVER (PARTITION BY category) AS n
  FROM (SELECT DISTINCT m.fraud_type, tx.category, tx.subcategory, tx.description
        FROM tx JOIN (VALUES {_MAPPED}) m(fraud_type, category) ON tx.category = m.category))""",
    f"""halves AS (SELECT *, 0 AS draw FROM cases WHERE category IN {_BLEND_CATEGORIES}
  QUALIFY {rank('blend', 'case_key', 'category')} <= count(*) OVER (PARTITION BY category) // 2)""",
    f"""blended AS (SELECT case_key, case_id, transaction_value, fraud_type, category, description,
         NULL AS subcategory, NULL AS data_ver FROM cases
  UNION ALL SELECT s.case_key, s.case_id, s.transaction_value, m.fraud_type, m.category,
         m.description, m.subcategory, 'non_fraud'
  FROM halves s JOIN (SELECT category, max(n) AS n FROM mapped GROUP BY category) z USING (category)
    JOIN mapped m ON m.category = s.category AND m.pos = {index('z.n', 'blend-text', 's.case_key', 's.draw')})""",
)


def blended(spark, sf_dir):
    cases, catalogue = stage(views.cases(spark, sf_dir)), views.texts(spark, sf_dir)
    return C.blend_descriptions(cases, map_categories(catalogue, BLEND_MAPPING)), catalogue


@query("k3_blend", on_tx("SELECT * FROM blended", *BLENDED))
def blend(spark, sf_dir):
    return blended(spark, sf_dir)[0]


REWRITTEN = ("Investment", "Groceries")
THINNED = (
    """target AS (SELECT * FROM blended
  WHERE category IN ('Investment', 'Groceries') AND subcategory IS NULL)""",
    f"""kept AS (SELECT * FROM target
  QUALIFY {rank('thin', 'case_key', 'category')} <= count(*) OVER (PARTITION BY category) // 3)""",
    f"""marked AS (SELECT *, {rank('thin', 'case_key', 'category')}
       <= (count(*) OVER (PARTITION BY category) * 5) // 6 AS rewrite FROM kept)""",
    f"""texts AS (SELECT *, count(*) OVER (PARTITION BY category) AS n, row_number() OVER (PARTITION BY category
         ORDER BY {u('rewrite-pool', 'subcategory', 'description')}, subcategory, description) - 1 AS pos
  FROM (SELECT DISTINCT category, subcategory, description FROM tx
        WHERE category IN ('Investment', 'Groceries')))""",
    f"""thinned AS (
  SELECT * FROM blended WHERE NOT (category IN ('Investment', 'Groceries') AND subcategory IS NULL)
  UNION ALL BY NAME SELECT * EXCLUDE (rewrite) FROM marked WHERE NOT rewrite
  UNION ALL BY NAME
  SELECT m.* EXCLUDE (rewrite, description), t.description
  FROM marked m JOIN (SELECT category, max(n) AS size FROM texts GROUP BY category) z USING (category)
    JOIN texts t ON t.category = m.category AND t.pos = {index('z.size', 'rewrite-text', 'm.case_key')}
  WHERE m.rewrite)""",
)


def thinned(spark, sf_dir):
    cases, catalogue = blended(spark, sf_dir)
    return C.thin_and_rewrite(stage(cases), catalogue, REWRITTEN)


@query("k4_thin_rewrite", on_tx("SELECT * FROM thinned", *BLENDED, *THINNED))
def thin_rewrite(spark, sf_dir):
    return thinned(spark, sf_dir)


@query(
    "k5_finalise",
    on_tx(
        f"""SELECT thinned.*, case_value FROM thinned JOIN (SELECT case_id, {exact_sum('transaction_value')}
            AS case_value FROM thinned WHERE transaction_value > 30000 GROUP BY case_id) USING (case_id)
        WHERE transaction_value > 30000""",
        *BLENDED,
        *THINNED,
    ),
)
def finalise(spark, sf_dir):
    return C.finalise_cases(stage(thinned(spark, sf_dir)), above=30000)


# K6 to K8 ------------------------------------------------------------------

CAPS = {c: S.MONTHLY_CAPS[c] for c in CATEGORY_OF_TYPE.values()}
MONTHLY = f"""monthly AS (SELECT tx.* FROM tx JOIN (VALUES {pairs(CAPS)}) caps(category, cap) ON tx.category = caps.category
  QUALIFY {rank('monthly', 'tx_id', "customer_id, date_trunc('month', tx_date), tx.category")} <= cap)"""
_MONTHLY_COLUMNS = ("tx_id", "customer_id", "tx_date", "category", "subcategory", "description", "amount")


def monthly(spark, sf_dir):
    return M.monthly_sample(ledger(spark, sf_dir, _MONTHLY_COLUMNS), CAPS)


@query("k6_monthly_sample", on_tx(f"SELECT {', '.join(_MONTHLY_COLUMNS)} FROM monthly", MONTHLY))
def monthly_sample(spark, sf_dir):
    return monthly(spark, sf_dir)


_MONTH = "CAST(date_trunc('month', tx_date) AS DATE)"
_BILL_DAY = f"""CAST(CASE WHEN category IN {texts(S.MONTH_START_CATEGORIES)}
       THEN greatest({_MONTH}, (SELECT min(tx_date) FROM {{source}}))
     WHEN category = {text(S.INCOME)} THEN {last_friday('tx_date')} ELSE tx_date END AS DATE)"""


@query(
    "k7_recurring_bills",
    on_tx(
        f"""SELECT tx_id, customer_id, {_BILL_DAY.format(source='tx')} AS tx_date, category, amount
        FROM carried""",
        CARRIED,
    ),
)
def recurring_bills(spark, sf_dir):
    columns = ("tx_id", "customer_id", "tx_date", "category", "amount")
    return M.recurring_bills(stage(ledger(spark, sf_dir, columns)))


_VARIED = f"""tx_id, customer_id, tx_date, category, subcategory, description,
  amount * {between(0.1, 0.5, 'variance', 'customer_id')} AS amount,
  CASE WHEN category IN {texts(S.INCOME_CATEGORIES)} OR contains(description, '{INCOMING_TEXT}')
       THEN 'income' ELSE 'spending' END AS tx_type"""


@query("k8_variability", on_tx(f"SELECT {_VARIED} FROM tx"))
def variability(spark, sf_dir):
    rows = ledger(
        spark,
        sf_dir,
        ("tx_id", "customer_id", "tx_date", "category", "subcategory", "description", "amount"),
    )
    return M.customer_variability(rows, incoming_text=INCOMING_TEXT)


@query(
    "k8_monthly_ledger",
    on_tx(
        f"SELECT {_VARIED} FROM billed",
        MONTHLY,
        CARRIED.replace("FROM tx)", "FROM monthly)")
        .replace("SELECT tx.* EXCLUDE", "SELECT monthly.* EXCLUDE")
        .replace("FROM tx, bounds", "FROM monthly, bounds")
        .replace("SELECT * FROM tx WHERE", "SELECT * FROM monthly WHERE"),
        f"billed AS (SELECT * REPLACE ({_BILL_DAY.format(source='monthly')} AS tx_date) FROM carried)",
    ),
)
def monthly_ledger(spark, sf_dir):
    """The three ledger steps in a row: sample, recurring bills, variability."""
    billed = M.recurring_bills(stage(monthly(spark, sf_dir)))
    return M.customer_variability(billed, incoming_text=INCOMING_TEXT)


# K9 ------------------------------------------------------------------------

HIGH_PER_MONTH, OTHER_PER_MONTH = 0.1, 0.06
_LEDGER = (
    "tx_id",
    "customer_id",
    "tx_date",
    "category",
    "subcategory",
    "description",
    "amount",
    "tx_type",
)
_COLUMNS = ", ".join(_LEDGER)
INJECTED = (
    f"ledger AS (SELECT {_COLUMNS} FROM tx WHERE fraud_type = 'none')",
    f"""sel AS (SELECT customer_id FROM (SELECT DISTINCT customer_id FROM ledger)
  QUALIFY {rank('sel', 'customer_id')} <= floor(count(*) OVER () * 0.3::DOUBLE))""",
    "chosen AS (SELECT * FROM ledger WHERE customer_id IN (SELECT customer_id FROM sel))",
    "months AS (SELECT count(DISTINCT date_trunc('month', tx_date)) AS m FROM chosen)",
    f"cut AS (SELECT quantile_cont(amount, 0.9) AS cut FROM chosen WHERE category = {text(S.INCOME)})",
    f"""quotas AS (SELECT customer_id, n, high_income,
         greatest(CAST(floor(CASE WHEN high_income THEN {HIGH_PER_MONTH}::DOUBLE ELSE {OTHER_PER_MONTH}::DOUBLE END * m) AS BIGINT)
           - {integer(0, 2, 'quota', 'customer_id')}, 0) AS quota
  FROM (SELECT customer_id, count(*) AS n, coalesce(arg_min(amount, (tx_date, tx_id))
          FILTER (WHERE category = {text(S.INCOME)}) > max(cut), false) AS high_income
        FROM chosen, cut GROUP BY customer_id), months)""",
    f"""pool AS (SELECT *, fraud_type = {text(S.HIGH_INCOME_FRAUD_TYPE)} AS high_income,
         row_number() OVER (PARTITION BY fraud_type = {text(S.HIGH_INCOME_FRAUD_TYPE)} ORDER BY {u('cases', 'tx_id')}, tx_id) - 1 AS pos
  FROM tx WHERE fraud_type NOT IN {texts([S.NO_FRAUD, S.EXCLUDED_FRAUD_TYPE])})""",
    "pool_sizes AS (SELECT high_income, count(*) AS size FROM pool GROUP BY high_income)",
    f"""slots AS (SELECT customer_id, tx_date, slot, high_income, least(quota, n) AS taken
  FROM (SELECT customer_id, tx_date, {rank('date', 'tx_id', 'customer_id')} - 1 AS slot FROM chosen)
    JOIN quotas USING (customer_id) WHERE slot < quota)""",
    f"""injected AS (SELECT concat_ws('|', 'fraud', s.customer_id, s.slot) AS tx_id, s.customer_id, s.tx_date,
         p.category, p.subcategory, p.description, p.amount, 'spending' AS tx_type,
         p.fraud_type, 1 AS customer_scammed
  FROM slots s JOIN pool_sizes z USING (high_income) JOIN pool p ON p.high_income = s.high_income
    AND p.pos = {distinct_position('z.size', 's.slot', 'case', 's.customer_id')})""",
    f"""candidates AS (SELECT customer_id, tx_id FROM chosen
  WHERE category NOT IN {texts(S.BILL_CATEGORIES)}
    AND (customer_id, tx_date) IN (SELECT customer_id, tx_date FROM slots))""",
)
_REMOVED = f"""removed AS (SELECT tx_id FROM (
    SELECT customer_id, tx_id, {rank('remove', 'tx_id', 'customer_id')} AS n FROM candidates)
  JOIN (SELECT customer_id, max(taken) AS taken FROM slots GROUP BY customer_id) USING (customer_id)
  WHERE n <= taken)"""
_REMOVED_WITH_REPLACEMENT = f"""ranked AS (SELECT *, {rank('remove', 'tx_id', 'customer_id')} - 1 AS pos,
    count(*) OVER (PARTITION BY customer_id) AS n FROM candidates),
removed AS (SELECT r.tx_id FROM slots s
  JOIN (SELECT customer_id, max(n) AS size FROM ranked GROUP BY customer_id) z USING (customer_id)
  JOIN ranked r ON r.customer_id = s.customer_id
    AND r.pos = {index('z.size', 'remove', 's.customer_id', 's.slot')})"""
_INJECT = f"""SELECT {_COLUMNS}, 'none' AS fraud_type,
       CAST(customer_id IN (SELECT customer_id FROM sel) AS INT) AS customer_scammed
  FROM ledger WHERE tx_id NOT IN (SELECT tx_id FROM removed)
  UNION ALL SELECT * FROM injected"""


def _ledger_and_cases(spark, sf_dir):
    rows = stage(ledger(spark, sf_dir, (*_LEDGER, "fraud_type")).withColumn("_drawn", L.customer_draw()))
    plain = rows.filter(F.col("fraud_type") == S.NO_FRAUD).drop("fraud_type")
    return plain, rows.filter(F.col("fraud_type") != S.NO_FRAUD).drop("_drawn")


def injected(spark, sf_dir, exact=True, written=False):
    plain, cases = _ledger_and_cases(spark, sf_dir)
    return L.inject_labels(
        plain,
        cases,
        high_per_month=HIGH_PER_MONTH,
        other_per_month=OTHER_PER_MONTH,
        exact=exact,
        strict=False,
        drawn="_drawn",
        written=written,
    )


@query("k9_inject_labels", on_tx(_INJECT, *INJECTED, _REMOVED))
def inject_labels(spark, sf_dir):
    return injected(spark, sf_dir)


@query("k9_inject_with_replacement", on_tx(_INJECT, *INJECTED, _REMOVED_WITH_REPLACEMENT))
def inject_with_replacement(spark, sf_dir):
    return injected(spark, sf_dir, exact=False)


# K10, K11 ------------------------------------------------------------------


def _banks_sql(source: str, utilities_from: str) -> str:
    return f"""drawn AS (SELECT * REPLACE (
    CASE WHEN tx_type = 'income' OR category = {text(S.INCOME)} THEN own ELSE bank_to END AS bank_to,
    CASE WHEN tx_type = 'spending' THEN own ELSE bank_from END AS bank_from)
  FROM (SELECT * EXCLUDE (bank_from, bank_to), {choice(S.BANKS, 'own', 'customer_id')} AS own,
          {choice(S.BANKS, 'to', 'tx_id')} AS bank_to, {choice(S.BANKS, 'from', 'tx_id')} AS bank_from
        FROM {source})),
employers AS (SELECT customer_id, arg_min(bank_from, (tx_date, tx_id)) AS employer
  FROM drawn WHERE category = {text(S.INCOME)} GROUP BY customer_id),
bills AS (SELECT tx_id, {choice(S.BANKS, 'utility', 'customer_id', 'position')} AS biller
  FROM (SELECT tx_id, customer_id, {rank('utility', 'tx_id', "customer_id, date_trunc('month', tx_date)", 'description')}
          AS position FROM drawn WHERE category = {text(S.UTILITIES)} AND fraud_type = {text(S.NO_FRAUD)})),
banked AS (SELECT drawn.* EXCLUDE (own, bank_to, bank_from),
    CASE WHEN category = {text(S.CASH_WITHDRAWAL)} THEN NULL WHEN biller IS NOT NULL THEN biller
         WHEN description IN {texts(S.OWN_BANK_DESCRIPTIONS)} THEN own ELSE bank_to END AS bank_to,
    CASE WHEN biller IS NOT NULL THEN {utilities_from}
         WHEN description IN {texts(S.OWN_BANK_DESCRIPTIONS)} THEN own
         WHEN category = {text(S.INCOME)} THEN employer ELSE bank_from END AS bank_from
  FROM drawn LEFT JOIN employers USING (customer_id) LEFT JOIN bills USING (tx_id))"""


_BANK_ROWS = (*_LEDGER, "fraud_type")


@query(
    "k10_assign_banks",
    on_tx(
        f"SELECT {_COLUMNS}, fraud_type, bank_to, bank_from FROM banked",
        _banks_sql("tx", "own"),
    ),
)
def assign_banks(spark, sf_dir):
    return B.assign_banks(stage(ledger(spark, sf_dir, _BANK_ROWS)))


@query(
    "k10_assign_banks_employer",
    on_tx(
        f"SELECT {_COLUMNS}, fraud_type, bank_to, bank_from FROM banked",
        _banks_sql("tx", "employer"),
    ),
)
def assign_banks_employer(spark, sf_dir):
    return B.assign_banks(stage(ledger(spark, sf_dir, _BANK_ROWS)), utilities_from="employer")


_FACTOR = between(1, 2, "factor", "customer_id")
_VARY = f"""SELECT *, {_FACTOR} AS factor_increase,
  CASE WHEN amount > 2 THEN amount * {_FACTOR} ELSE amount + 4 END AS new_amount"""


@query("k11_vary_amounts", on_tx(f"{_VARY} FROM (SELECT tx_id, customer_id, amount FROM tx)"))
def vary_amounts(spark, sf_dir):
    return B.vary_amounts(ledger(spark, sf_dir, ("tx_id", "customer_id", "amount")))


@query(
    "k11_final_bank_data",
    on_tx(
        f"{_VARY} FROM banked",
        *INJECTED,
        _REMOVED,
        f"relabelled AS (SELECT *, NULL AS bank_from, NULL AS bank_to FROM ({_INJECT}))",
        _banks_sql("relabelled", "own"),
    ),
)
def final_bank_data(spark, sf_dir):
    """Label injection, bank assignment and amount variation in a row."""
    return B.vary_amounts(B.assign_banks(injected(spark, sf_dir, written=True)))


# K12, K13 ------------------------------------------------------------------


def _summary_sql(label: str, rules: str) -> str:
    return on_tx(
        f"""SELECT 'flows' AS section, concat(bank_from, ' > ', bank_to) AS item,
               CAST(count(*) AS DOUBLE) AS value
        FROM tx WHERE bank_to IS NOT NULL AND {label} GROUP BY bank_from, bank_to
        UNION ALL SELECT 'averages', category, average FROM ({AVERAGE.format(also=rules)})
        UNION ALL SELECT 'spend', format('Spent: £{{:,}} ', CAST(spent AS BIGINT)), spent
        FROM (SELECT round_even({exact_sum('amount')}, 0) AS spent FROM tx
              WHERE tx_type = 'spending' AND {label})
        UNION ALL SELECT 'customers', customer_scammed, customers FROM ({COUNTS})""",
        FLAGS,
    )


def _summary(spark, sf_dir, label):
    columns = ("bank_from", "bank_to", "category", "tx_type", "amount", "fraud_type")
    rows = (labelled if label == "fraud" else ledger)(spark, sf_dir, columns)
    flags = views.customer_flags(spark, sf_dir)
    return P.summary_table(P.label_summary(rows, flags, label))


@query("k12_summary_fraud", _summary_sql("fraud_type <> 'none'", "fraud_type <> 'none'"))
def summary_fraud(spark, sf_dir):
    return _summary(spark, sf_dir, "fraud")


@query("k12_summary_nonfraud", _summary_sql("fraud_type = 'none'", NONFRAUD))
def summary_nonfraud(spark, sf_dir):
    return _summary(spark, sf_dir, "non-fraud")


_GRAPH = (
    """flows AS (SELECT bank_from, bank_to, count(*) AS n FROM tx
  WHERE bank_to IS NOT NULL GROUP BY bank_from, bank_to)""",
    """nodes AS (SELECT dense_rank() OVER (ORDER BY side DESC, bank) - 1 AS node_id, side, bank
  FROM (SELECT 'sender' AS side, bank_from AS bank FROM flows
        UNION SELECT 'receiver', bank_to FROM flows))""",
)


@query(
    "k13_flow_graph",
    on_tx(
        """SELECT s.node_id AS source_id, t.node_id AS target_id, bank_from, bank_to, n
        FROM flows JOIN nodes s ON s.side = 'sender' AND s.bank = bank_from
          JOIN nodes t ON t.side = 'receiver' AND t.bank = bank_to""",
        *_GRAPH,
    ),
)
def flow_graph(spark, sf_dir):
    return P.flow_graph(ledger(spark, sf_dir, ("bank_from", "bank_to")))[1]


@query("k13_flow_nodes", on_tx("SELECT * FROM nodes", *_GRAPH))
def flow_nodes(spark, sf_dir):
    return P.flow_graph(ledger(spark, sf_dir, ("bank_from", "bank_to")))[0]
