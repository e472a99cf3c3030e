"""Monthly ledgers: samples per customer and month, recurring bills, variability."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import calendar as cal
from txlab.functions.columns import literal_map
from txlab.functions.draws import SEED
from txlab.operators.joins import carry_forward, date_span
from txlab.operators.rows import classify_flow, scale_by_entity
from txlab.operators.sampling import lowest_n


def monthly_sample(
    tx: DataFrame, caps: Mapping[str, int] = S.MONTHLY_CAPS, key: str = "tx_id", seed: int = SEED
) -> DataFrame:
    """Per customer, month and category at most the category's cap of the ledger's own rows.

    Rows of a category without a cap, and undated rows, drop out.
    """
    cap = F.try_element_at(literal_map(caps), F.col("category"))
    rows = tx.withColumns({"_month": cal.month_start("tx_date"), "_cap": cap})
    rows = rows.filter(F.col("_month").isNotNull() & F.col("_cap").isNotNull())
    cell = ["customer_id", "_month", "category"]
    lowest = lowest_n(rows, cell, max(caps.values()), [key], "monthly", "_n", seed)
    return lowest.filter(F.col("_n") <= F.col("_cap")).drop("_n", "_cap", "_month")


def recurring_bills(tx: DataFrame) -> DataFrame:
    """First-month bills repeat monthly: rent and utilities at the month's start, income on its last Friday.

    The first month starts on the ledger's first day, later ones on day 1.  An
    undated row keeps no date.
    """
    span = date_span(tx)
    start = F.lit(span[0]).cast("date")
    bills = carry_forward(tx, S.BILL_CATEGORIES, span)
    month = cal.month_start("tx_date")
    day = (
        F.when(F.col("tx_date").isNull(), F.lit(None).cast("date"))
        .when(F.col("category").isin(*S.MONTH_START_CATEGORIES), F.greatest(month, start))
        .when(F.col("category") == S.INCOME, cal.last_friday("tx_date"))
        .otherwise(F.col("tx_date"))
    )
    return bills.withColumn("tx_date", day)


def customer_variability(
    tx: DataFrame,
    low: float = 0.1,
    high: float = 0.5,
    incoming_text: str = S.INCOMING_TEXT,
    seed: int = SEED,
) -> DataFrame:
    """Scale every amount by the customer's factor, then derive income or spending."""
    return classify_flow(
        scale_by_entity(tx, low=low, high=high, salt="variance", seed=seed), incoming_text
    )
