"""Counterparty banks by rule, and per-customer amount factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions.columns import adjusted_amount
from txlab.functions.draws import SEED, draw_choice, draw_uniform
from txlab.operators.aggregates import first_in_group
from txlab.operators.joins import join_same_group
from txlab.operators.windows import tile_by_position

CUSTOMER = "customer_id"
ORDER = ("tx_date", "tx_id")


def assign_banks(
    tx: DataFrame,
    banks: Sequence[str] = S.BANKS,
    utilities_from: str = "own",
    seed: int = SEED,
) -> DataFrame:
    """Set bank_to and bank_from of every row.

    Income lands in the customer's own bank and spending leaves it; all Income
    comes from one employer bank; own-account descriptions stay inside; the
    i-th utility bill of each month goes to the same bank; a cash withdrawal has
    no receiver.  Only Income and Utilities rows are shuffled.
    """
    if utilities_from not in ("own", "employer"):
        raise ValueError(f"unknown utilities_from {utilities_from!r}")
    category = F.col("category")
    # Missing values match no rule, and belong to no branch but the last.
    is_income = category.eqNullSafe(S.INCOME)
    is_utility = category.eqNullSafe(S.UTILITIES) & F.col("fraud_type").eqNullSafe(S.NO_FRAUD)
    is_cash = F.coalesce(category == S.CASH_WITHDRAWAL, F.lit(False))
    inside = F.coalesce(F.col("description").isin(*S.OWN_BANK_DESCRIPTIONS), F.lit(False))
    lands, leaves = F.col("tx_type") == "income", F.col("tx_type") == "spending"
    own, employer = F.col("_own"), F.col("_employer")
    # A draw is a hash of texts, a large part of the time: each is made where a row needs it, after shuffles.
    drawn_to, drawn_from = (draw_choice(banks, "tx_id", salt=salt, seed=seed) for salt in ("to", "from"))

    def with_own(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_own", draw_choice(banks, CUSTOMER, salt="own", seed=seed))

    bare = tx.drop("bank_to", "bank_from")
    first = first_in_group(bare, [CUSTOMER], is_income, ORDER, ["tx_id", "tx_type"])
    employers = with_own(first).select(CUSTOMER, F.when(leaves, own).otherwise(drawn_from).alias("_employer"))
    income = with_own(join_same_group(bare.filter(is_income), employers, [CUSTOMER]))
    income = income.withColumns({"bank_to": own, "bank_from": F.when(inside, own).otherwise(employer)}).drop("_employer")
    plain = with_own(tx.filter(~is_income & ~is_utility)).withColumns(
        {
            "bank_to": F.when(is_cash, F.lit(None)).when(inside | lands, own).otherwise(drawn_to),
            "bank_from": F.when(inside | leaves, own).otherwise(drawn_from),
        }
    )
    utilities = tile_by_position(bare.filter(is_utility), banks, "bank_to", salt="utility", seed=seed)
    if utilities_from == "own":
        utilities = with_own(utilities).withColumn("bank_from", own)
    else:
        utilities = with_own(join_same_group(utilities, employers, [CUSTOMER]))
        utilities = utilities.withColumnRenamed("_employer", "bank_from")
    return plain.unionByName(income).unionByName(utilities).drop("_own")


def vary_amounts(
    tx: DataFrame, low: float = 1.0, high: float = 2.0, amount: str = "amount", seed: int = SEED
) -> DataFrame:
    """A factor per customer, drawn in place, and the amount changed by it."""
    return tx.withColumn(
        "factor_increase", draw_uniform(low, high, CUSTOMER, salt="factor", seed=seed)
    ).withColumn("new_amount", adjusted_amount(amount, "factor_increase"))
