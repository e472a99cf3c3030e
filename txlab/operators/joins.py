"""Joins and table combinations.

No side is hinted for broadcast here: Spark decides from the size of the
written table or, at run time, from the shuffled bytes, and splits skewed
partitions of hot keys.  It can do so only between two plain shuffles, so facts
of a group are written before they are joined to its rows.  Key lists are made distinct before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlab.functions.columns import literal_map
from txlab.functions.draws import SEED
from txlab.operators.ranking import rank_in_group
from txlab.sources.staging import stage


#: Keys that rows without a group are spread over.
_SPREAD = 1 << 20


def join_factor(tx: DataFrame, factors: DataFrame, on: str = "customer_id") -> DataFrame:
    return tx.join(factors, on)


def attach_total(
    df: DataFrame, totals: DataFrame, on: Sequence[str] = ("case_id",)
) -> DataFrame:
    """Per-group values back onto rows; rows without a group keep null.

    Rows without a group match nothing, but as equal keys a shuffle would send
    them all to one task, so each gets one of many keys of its own.
    """
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    spread = F.when(missing, F.monotonically_increasing_id() % _SPREAD + 1).otherwise(0)
    # The totals' key is written, so that it isn't taken for a constant.
    totals = stage(totals.withColumn("_spread", F.lit(0).cast("long")))
    return df.withColumn("_spread", spread).join(totals, [*on, "_spread"], "left").drop("_spread")


def join_same_group(
    rows: DataFrame, facts: DataFrame, by: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join per-group facts onto rows; the missing group is a group like any other."""
    keys = {c: f"_key_{c}" for c in by}
    renamed = stage(facts).withColumnsRenamed(keys)
    same = reduce(Column.__and__, [rows[c].eqNullSafe(renamed[k]) for c, k in keys.items()])
    return rows.join(renamed, same, how).drop(*keys.values())


def remove_rows(df: DataFrame, removed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``removed``; a key listed twice removes no more."""
    return df.join(removed.select(*key).distinct(), list(key), "left_anti")


def keep_customers(
    df: DataFrame, customers: DataFrame, on: str = "customer_id"
) -> DataFrame:
    return df.join(customers.select(on).distinct(), on, "left_semi")


def exclude_customers(
    df: DataFrame, customers: DataFrame, on: str = "customer_id"
) -> DataFrame:
    return df.join(customers.select(on).distinct(), on, "left_anti")


def keep_on_dates(
    df: DataFrame, dates: DataFrame, on: Sequence[str] = ("customer_id", "tx_date")
) -> DataFrame:
    return df.join(dates.select(*on).distinct(), list(on), "left_semi")


def merge_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on every shared column, missing values matching each other.

    Rows equal in all shared columns fold into one.  If n such rows meet m, all
    n x m pairs appear; ``merge_matched`` gives max(n, m) rows instead.
    """
    return _merged(left, right, [c for c in left.columns if c in right.columns])


def merge_matched(left: DataFrame, right: DataFrame, seed: int = SEED) -> DataFrame:
    """``merge_common`` that matches each row with one row at most: n equal rows and m give max(n, m).

    Rows that are equal in all shared columns are numbered on both sides, in the
    order of their other columns, and meet by number. As the number is part of
    the join key, a row that a third of all rows equal is no hot key.
    """
    shared = [c for c in left.columns if c in right.columns]

    def numbered(df: DataFrame) -> DataFrame:
        # Told apart by their ids, wholly equal rows can be dealt out; which of them has which number is all the same.
        rows = df.withColumn("_tie", F.monotonically_increasing_id())
        rest = [c for c in df.columns if c not in shared]
        return rank_in_group(rows, shared, ["_tie"], prefix=rest, salt="merge", name="_number", seed=seed).drop("_tie")

    return _merged(numbered(left), numbered(right), [*shared, "_number"]).drop("_number")


def _merged(left: DataFrame, right: DataFrame, shared: Sequence[str]) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    same = reduce(
        Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in shared]
    )
    only_left = [F.col(f"a.{c}") for c in left.columns if c not in shared]
    only_right = [F.col(f"b.{c}") for c in right.columns if c not in shared]
    return a.join(b, same, "full").select(
        *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in shared],
        *only_left,
        *only_right,
    )


def lookup(
    df: DataFrame,
    column: str,
    values: Mapping,
    name: str,
    strict: bool = True,
) -> DataFrame:
    """Value of each row's key in a literal table; ``strict`` fails on a key it lacks."""
    found = F.try_element_at(literal_map(values), F.col(column))
    if strict:
        message = F.concat(F.lit(f"no {name} for "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
        # The error never gives a value, so it takes the type of the values.
        kind = df.select(found.alias("found")).schema["found"].dataType
        found = F.when(found.isNull(), F.raise_error(message).cast(kind)).otherwise(found)
    return df.withColumn(name, found)


def map_categories(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    column: str = "category",
    name: str = "fraud_type",
) -> DataFrame:
    """One row per group whose list holds the row's value; rows in no list drop out."""
    groups: dict[str, list[str]] = {}
    for group, members in mapping.items():
        for member in members:
            groups.setdefault(member, []).append(group)
    table = literal_map({k: F.array(*[F.lit(g) for g in v]) for k, v in groups.items()})
    return df.withColumn(name, F.explode(F.try_element_at(table, F.col(column))))


def zip_columns(
    left: DataFrame,
    right: DataFrame,
    left_key: Sequence[str],
    right_key: Sequence[str],
    salt: str = "zip",
    how: str = "strict",
    seed: int = SEED,
) -> DataFrame:
    """Glue two tables by position in the order of their key hashes.

    Tables of unequal size are an error; ``how="full"`` keeps the longer one's
    rows with nothing beside them.
    """
    if how not in ("strict", "full"):
        raise ValueError(f"unknown how {how!r}")
    if how == "strict" and (sizes := (left.count(), right.count()))[0] != sizes[1]:
        raise ValueError(f"the tables have {sizes[0]} and {sizes[1]} rows")
    a = rank_in_group(left, [], left_key, salt=salt, name="position", seed=seed)
    b = rank_in_group(right, [], right_key, salt=salt, name="position", seed=seed)
    return a.join(b, "position", "full")


def skeleton(df: DataFrame, by: Sequence[str], date: str = "tx_date") -> DataFrame:
    """Every month from a group's first to its last dated row, also those it has no row in.

    One row (group, month_start, month_end) each, made from the group's own two ends.
    """
    ends = (
        df.filter(F.col(date).isNotNull())
        .groupBy(*by)
        .agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    )
    months = F.sequence(F.trunc("_first", "MM"), F.trunc("_last", "MM"), F.expr("INTERVAL 1 MONTH"))
    return ends.select(*by, F.explode(months).alias("month_start")).withColumn(
        "month_end", F.last_day("month_start")
    )


def carry_forward(
    tx: DataFrame,
    categories: Sequence[str],
    span: tuple[date, date] | None = None,
    key: str = "tx_id",
) -> DataFrame:
    """First-month rows of the categories repeat in each later month of the ledger.

    They replace the rows of those categories that the later months have.  A row
    without a date belongs to no month and stays as it is.
    ``span``: the ledger's first and last day, if known.
    """
    first, last = span or date_span(tx)
    if first is None:
        return tx
    later = (last.year - first.year) * 12 + last.month - first.month
    recurring = F.coalesce(F.col("category").isin(*categories), F.lit(False)) & F.col("tx_date").isNotNull()
    in_first_month = F.col("tx_date") <= F.last_day(F.lit(first))
    ahead = F.col("_ahead")
    repeated = (
        tx.filter(recurring & in_first_month)
        .withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(later))))
        .withColumn("tx_date", F.add_months(F.col("tx_date"), ahead))
        .withColumn(
            key,
            F.when(ahead == 0, F.col(key)).otherwise(
                F.concat_ws("#", F.col(key), ahead.cast("string"))
            ),
        )
        .drop("_ahead")
    )
    return tx.filter(~recurring).unionByName(repeated)


def date_span(tx: DataFrame, column: str = "tx_date") -> tuple[date, date]:
    """First and last day of the ledger, as two values."""
    row = tx.agg(F.min(column).alias("first"), F.max(column).alias("last")).first()
    return row["first"], row["last"]


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def union_relaxed(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name: missing columns are null, types widen to one that holds both."""
    texts = {
        f.name
        for f in left.schema.fields
        if f.name in right.columns and not _widens(f.dataType, right.schema[f.name].dataType)
    }

    def as_text(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c in texts})

    return as_text(left).unionByName(as_text(right), allowMissingColumns=True)


def _widens(a: T.DataType, b: T.DataType) -> bool:
    """Whether a union holds both types without turning them into texts."""
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    kinds = (T.NumericType, dates, T.NullType)
    return a == b or any(isinstance(a, k) and isinstance(b, k) for k in kinds) or T.NullType in (type(a), type(b))


def values_missing_from(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of the column that the other table never has."""
    return left.select(column).subtract(right.select(column))
