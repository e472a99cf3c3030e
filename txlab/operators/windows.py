"""Steps that look at a whole group for each row, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import calendar as cal
from txlab.functions.columns import money_sum
from txlab.functions.draws import SEED, draw_choice
from txlab.operators.aggregates import first_in_group
from txlab.operators.joins import attach_total, join_same_group
from txlab.operators.quantiles import exact_quantiles
from txlab.operators.ranking import SMALL, rank_in_group


def row_key(
    df: DataFrame,
    by: Sequence[str] = ("customer_id",),
    key: Sequence[str] = ("tx_id",),
    name: str = "row_key",
    seed: int = SEED,
) -> DataFrame:
    """0-based row number in the group, in hash order of the business key."""
    ranked = rank_in_group(df, by, key, salt="row", name=name, seed=seed)
    return ranked.withColumn(name, F.col(name) - 1)


def first_value_broadcast(
    df: DataFrame,
    condition: Column,
    column: str,
    by: Sequence[str] = ("customer_id",),
    order: Sequence[str] = ("tx_date", "tx_id"),
) -> DataFrame:
    """Matching rows of a group all take the first one's value; only they are shuffled."""
    matching = F.coalesce(condition, F.lit(False))
    first = first_in_group(df, by, matching, order, [column])
    taken = join_same_group(df.filter(matching).drop(column), first, by).select(*df.columns)
    return df.filter(~matching).unionByName(taken)


def tile_by_position(
    df: DataFrame,
    values: Sequence[str],
    name: str,
    by: Sequence[str] = ("customer_id",),
    date: str = "tx_date",
    prefix: Sequence[str] = ("description",),
    key: Sequence[str] = ("tx_id",),
    salt: str = "tile",
    seed: int = SEED,
) -> DataFrame:
    """The i-th row of a group gets the same drawn value in every month."""
    monthly = df.withColumn("_month", cal.month_start(date))
    ranked = rank_in_group(
        monthly,
        [*by, "_month"],
        key,
        prefix=prefix,
        salt=salt,
        name="_position",
        seed=seed,
        small=SMALL,
    )
    return ranked.withColumn(name, draw_choice(values, *by, "_position", salt=salt, seed=seed)).drop(
        "_position", "_month"
    )


def group_total_on_rows(
    df: DataFrame, by: str = "case_id", value: str = "amount", name: str = "group_total"
) -> DataFrame:
    """The group's sum on each of its rows; a missing group has none."""
    totals = df.filter(F.col(by).isNotNull()).groupBy(by).agg(money_sum(value).alias(name))
    return attach_total(df, totals, [by])


def income_rank_flag(
    tx: DataFrame,
    q: float = 0.9,
    customer: str = "customer_id",
    order: Sequence[str] = ("tx_date", "tx_id"),
) -> DataFrame:
    """Per customer: the first Income amount, and whether it exceeds the q-quantile of all Income rows.

    A customer without Income rows is not high-income.
    """
    income = F.col("category") == S.INCOME
    cut = exact_quantiles(tx.filter(income), "amount", [q]).first()
    first = F.min_by("amount", F.when(income, F.struct(*order)))
    return (
        tx.groupBy(customer)
        .agg(first.alias("first_income"))
        .withColumn("high_income", F.coalesce(F.col("first_income") > F.lit(cut["value"] if cut else None).cast("double"), F.lit(False)))
    )
