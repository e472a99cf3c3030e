"""Substituting labelled fraud rows into some customers' ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import calendar as cal
from txlab.functions.draws import SEED, draw_int, uniform
from txlab.operators.joins import keep_on_dates, remove_rows
from txlab.operators.quantiles import exact_quantiles
from txlab.operators.sampling import (
    at_position,
    distinct_position,
    index_pool,
    is_selected,
    lowest_n,
    pick,
)
from txlab.sources.staging import stage

CUSTOMER = "customer_id"


def customer_draw(seed: int = SEED) -> Column:
    """The draw by which ``inject_labels`` chooses customers."""
    return uniform(CUSTOMER, salt="sel", seed=seed)


def customer_facts(chosen: DataFrame) -> DataFrame:
    """Per customer the rows, the months with rows and the first Income amount, in one aggregate."""
    income = F.col("category") == S.INCOME
    return chosen.groupBy(CUSTOMER).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.collect_set(cal.month_start("tx_date")).alias("_months"),
        F.min_by("amount", F.when(income, F.struct("tx_date", "tx_id"))).alias("_income"),
    )


def customer_quotas(
    facts: DataFrame,
    cut: float | None,
    high_per_month: float,
    other_per_month: float,
    months: int,
    seed: int = SEED,
) -> DataFrame:
    """Per customer: which pool its fraud comes from and how many rows.

    A customer whose first Income amount is above ``cut`` is high-income; one
    without Income is not.
    """
    high = F.coalesce(F.col("_income") > F.lit(cut).cast("double"), F.lit(False))
    total = F.when(high, int(high_per_month * months)).otherwise(int(other_per_month * months))
    drawn = total - draw_int(0, 2, CUSTOMER, salt="quota", seed=seed)
    return facts.select(CUSTOMER, high.alias("high_income"), "_rows", F.greatest(drawn, F.lit(0)).alias("quota"))


def inject_labels(
    ledger: DataFrame,
    cases: DataFrame,
    share: float = 0.3,
    high_per_month: float = 5,
    other_per_month: float = 3,
    q: float = 0.9,
    exact: bool = True,
    strict: bool = True,
    seed: int = SEED,
    drawn: str | None = None,
    written: bool = False,
) -> DataFrame:
    """Replace ordinary rows of ``share`` of the customers by fraud rows.

    ``ledger``: tx_id, customer_id, tx_date, category, subcategory, description,
    amount, tx_type.  ``cases``: the same texts and amount with fraud_type, and
    a unique tx_id.  Totals per customer are the months of the chosen customers'
    ledgers (of each year) times the per-month number, less 0 to 2.  Each fraud row falls on the date of one of the customer's
    rows.  As many rows on those dates leave, never Income, Housing or
    Utilities.  ``exact=False`` draws the rows to remove with replacement, so
    fewer leave.  A customer with fewer rows than fraud rows to place is an
    error; without ``strict`` it gets as many as it has rows.  ``drawn``: a column
    of the ledger with its rows' ``customer_draw``, which isn't returned.  With
    ``written`` the chosen customers' new rows are written, for a result that is
    read several times.
    """
    selected = is_selected(ledger, CUSTOMER, share, seed=seed, drawn=drawn)
    untouched = ledger.filter(~selected)
    # Every further pass reads only the chosen customers' rows.
    chosen = stage(ledger.filter(selected).drop(*[c for c in [drawn] if c]))
    facts = stage(customer_facts(chosen))
    months = facts.select(F.explode("_months")).distinct().count()
    # A customer above the q-quantile of all chosen Income rows is high-income.
    cut = exact_quantiles(chosen.filter(F.col("category") == S.INCOME), "amount", [q], written=True).first()
    most = int(max(high_per_month, other_per_month) * months)
    quotas = customer_quotas(facts, cut["value"] if cut else None, high_per_month, other_per_month, months, seed)
    pool = _case_pool(cases, seed)
    _check_quotas(quotas, pool, strict)

    # The dated places for fraud rows: at most `most` per customer.
    slots = (
        lowest_n(chosen.select(CUSTOMER, "tx_id", "tx_date"), [CUSTOMER], most, ["tx_id"], "date", "_n", seed)
        .join(quotas, CUSTOMER)
        .filter(F.col("_n") <= F.col("quota"))
        .select(
            CUSTOMER,
            "high_income",
            (F.col("_n") - 1).alias("slot"),
            "tx_date",
            "quota",
            F.least("quota", "_rows").alias("_taken"),
        )
    )
    slots = stage(slots)
    injected = _draw_cases(slots, pool, seed)
    removed = _rows_to_remove(chosen, slots, most, exact, seed)
    kept = remove_rows(chosen, removed, ["tx_id"])
    ordinary = [F.col(c) for c in ledger.columns if c not in ("fraud_type", "customer_scammed", drawn)]

    def labelled(df: DataFrame, fraud_type: Column, flag: int) -> DataFrame:
        return df.select(
            *ordinary, fraud_type.alias("fraud_type"), F.lit(flag).alias("customer_scammed")
        )

    none = F.lit(S.NO_FRAUD)
    changed = labelled(kept, none, 1).unionByName(
        injected.withColumn("customer_scammed", F.lit(1)), allowMissingColumns=True
    )
    return labelled(untouched, none, 0).unionByName(stage(changed) if written else changed)


def _case_pool(cases: DataFrame, seed: int):
    """Fraud rows to draw from: one pool for high-income customers, one for the others."""
    usable = cases.filter(F.col("fraud_type") != S.EXCLUDED_FRAUD_TYPE).withColumn(
        "high_income", F.col("fraud_type") == S.HIGH_INCOME_FRAUD_TYPE
    )
    return index_pool(usable, ["high_income"], ["tx_id"], salt="cases", seed=seed)


def _check_quotas(quotas: DataFrame, pool, strict: bool) -> None:
    """Customers have enough rows (``strict``), and none draws more fraud rows than its pool holds."""
    short = F.bool_or(F.col("_rows") < F.col("quota")).alias("short")
    asked = quotas.groupBy("high_income").agg(short, F.max(F.least("quota", "_rows")).alias("most")).collect()
    if strict and any(row["short"] for row in asked):
        raise ValueError("a customer has fewer rows than fraud rows to place")
    sizes = {row["high_income"]: row["_pool_size"] for row in pool.sizes.collect()}
    for row in asked:
        held = sizes.get(row["high_income"], 0)
        if held < row["most"]:
            raise ValueError(f"the fraud pool holds {held} rows, {row['most']} are drawn for a customer")


def _draw_cases(slots: DataFrame, pool, seed: int) -> DataFrame:
    """One fraud row per slot; no case comes twice for a customer."""
    sized = slots.join(pool.sizes, "high_income")
    position = distinct_position(F.col("_pool_size"), F.col("slot"), CUSTOMER, salt="case", seed=seed)
    drawn = at_position(
        sized.withColumn("_pos", position),
        pool,
        ["category", "subcategory", "description", "amount", "fraud_type"],
    )
    return drawn.select(
        F.concat_ws("|", F.lit("fraud"), F.col(CUSTOMER).cast("string"), F.col("slot").cast("string")).alias("tx_id"),
        CUSTOMER,
        "tx_date",
        "category",
        "subcategory",
        "description",
        "amount",
        F.lit("spending").alias("tx_type"),
        "fraud_type",
    )


def _rows_to_remove(chosen: DataFrame, slots: DataFrame, most: int, exact: bool, seed: int) -> DataFrame:
    """Unprotected rows on the slots' dates, as many as fraud rows come in."""
    protected = F.coalesce(F.col("category").isin(*S.BILL_CATEGORIES), F.lit(False))
    candidates = keep_on_dates(
        chosen.filter(~protected).select(CUSTOMER, "tx_id", "tx_date"), slots
    ).select(CUSTOMER, "tx_id")
    if exact:
        taken = slots.filter("slot = 0").select(CUSTOMER, "_taken")
        ranked = lowest_n(candidates, [CUSTOMER], most, ["tx_id"], "remove", "_n", seed)
        return ranked.join(taken, CUSTOMER).filter("_n <= _taken")
    indexed = index_pool(candidates, [CUSTOMER], ["tx_id"], salt="remove", seed=seed)
    return pick(slots.select(CUSTOMER, "slot"), indexed, [CUSTOMER, "slot"], "remove", ["tx_id"], seed=seed)
