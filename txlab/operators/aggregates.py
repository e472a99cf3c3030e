"""Grouped aggregates.  All combine on the map side, so hot groups cost nothing extra.

Whole rows that are the least of a group are carried as one struct, which Spark
aggregates by sorting instead of hashing; the order of rows is a short key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import columns as C
from txlab.functions.draws import SEED
from txlab.operators.ranking import rank_in_group
from txlab.operators.rows import split_label


def bank_flows(tx: DataFrame, label: str | None = None) -> DataFrame:
    """Rows per (bank_from, bank_to); rows that lack a bank are no flow."""
    if label:
        tx = split_label(tx, label)
    known = F.col("bank_from").isNotNull() & F.col("bank_to").isNotNull()
    return tx.filter(known).groupBy("bank_from", "bank_to").agg(F.count(F.lit(1)).alias("n"))


def averaged_rows(label: str) -> Column:
    """Which rows enter the category averages of a label."""
    other = lambda column, value: ~F.col(column).eqNullSafe(F.lit(value))
    no_investment = other("category", S.INVESTMENT)
    if label == "fraud":
        return no_investment
    return no_investment & other("tx_type", "income") & other("category", S.HOUSING)


def category_average(tx: DataFrame, label: str, amount: str = "amount") -> DataFrame:
    """Mean amount per category, largest first, rounded half-even to whole units."""
    return (
        split_label(tx, label)
        .filter(averaged_rows(label) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(C.money_mean(amount).alias("_mean"))
        .orderBy(F.desc("_mean"), "category")
        .select("category", C.half_even("_mean").alias("average"))
    )


def spend_total(tx: DataFrame, label: str, amount: str = "amount") -> DataFrame:
    return (
        split_label(tx, label)
        .filter(F.col("tx_type") == "spending")
        .agg(C.half_even(F.coalesce(C.money_sum(amount), F.lit(0.0))).alias("spent"))
    )


def scammed_counts(
    tx: DataFrame, customer: str = "customer_id", flag: str = "customer_scammed"
) -> DataFrame:
    """Distinct customers per flag, as text, ``scammed`` first."""
    return (
        tx.select(customer, flag)
        .distinct()
        .groupBy(flag)
        .agg(F.count(customer).alias("customers"))
        .select(C.flag_text(flag).alias(flag), "customers")
        .orderBy(F.desc(flag))
    )


def counts_by(df: DataFrame, key: str) -> DataFrame:
    """Non-null count of every other column per key."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.count(c).alias(c) for c in df.columns if c != key])
    )


def group_totals(
    df: DataFrame, by: str = "case_id", value: str = "transaction_value", name: str = "case_value"
) -> DataFrame:
    """Sum per group; rows without a group have no total."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(C.money_sum(value).alias(name))


def customer_mean(
    tx: DataFrame, customer: str = "customer_id", amount: str = "new_amount"
) -> DataFrame:
    return tx.groupBy(customer).agg(F.avg(amount).alias("mean_amount"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of different values per column; a missing value counts as one."""
    return df.agg(
        *[
            (F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c)
            for c in columns
        ]
    )


def approximate_distinct_counts(df: DataFrame, columns: Sequence[str], error: float = 0.02) -> DataFrame:
    """The same from mergeable sketches, within ``error`` (relative), in one pass and without a shuffle of values."""
    return df.agg(
        *[
            (F.approx_count_distinct(c, error) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c)
            for c in columns
        ]
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def sort_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *ties)


def drop_duplicates(
    df: DataFrame, columns: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key; with other columns present, the first in the stated order."""
    rest = [c for c in df.columns if c not in columns]
    if not rest:
        return df.dropDuplicates(list(columns))
    if not order:
        raise ValueError("state an order: which duplicate stays must not depend on partitioning")
    kept = df.groupBy(*columns).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*columns, "_row.*").select(*df.columns)


def mean_outflow(flows: DataFrame, divisor: float = 10000) -> DataFrame:
    """Per sender the mean count of its edges, in units of ``divisor``."""
    return flows.groupBy("bank_from").agg((F.avg("n") / F.lit(float(divisor))).alias("mean_outflow"))


def group_lists(df: DataFrame, key: str, columns: Sequence[str], seed: int = SEED) -> DataFrame:
    """The list of each key as rows (key, position, columns), in hash order of the columns.

    A list per key in one cell would put a whole group into one task; numbered
    rows hold the same list at any size and can be joined by position.
    """
    members = df.filter(F.col(key).isNotNull()).select(key, *columns).distinct()
    return rank_in_group(members, [key], list(columns), salt="list", name="position", seed=seed)


def first_in_group(
    df: DataFrame,
    by: Sequence[str],
    condition: Column,
    order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Columns of the first matching row of each group in a stated order."""
    return (
        df.filter(condition)
        .groupBy(*by)
        .agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
        .select(*by, *[F.col(f"_first.{c}").alias(c) for c in columns])
    )


def empty_groups(groups: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Each group with its number of rows in ``df`` and whether it has none."""
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        groups.select(column)
        .distinct()
        .join(sizes, column, "left")
        .select(column, F.coalesce("n", F.lit(0)).alias("n"))
        .withColumn("is_empty", F.col("n") == 0)
    )
