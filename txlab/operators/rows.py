"""Projections, filters and row-wise rewrites.  All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import columns as C
from txlab.functions.draws import SEED, draw_uniform
from txlab.operators.quantiles import exact_quantiles


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of another table, in its order."""
    return df.select(*like.columns)


def tag(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def rescale(df: DataFrame, column: str, divisor: float = 100) -> DataFrame:
    return df.withColumn(column, F.col(column) / F.lit(divisor))


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def where_ne(df: DataFrame, column: str, value, keep_missing: bool = False) -> DataFrame:
    """Rows that differ from ``value``; missing ones differ only if asked for."""
    same = F.col(column).eqNullSafe(F.lit(value)) if keep_missing else F.col(column) == F.lit(value)
    return df.filter(~same)


def where_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def where_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def where_all(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    return df.filter(reduce(Column.__and__, conditions))


def where_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def where_gt(df: DataFrame, column: str, value, or_equal: bool = False) -> DataFrame:
    bound = F.lit(value)
    return df.filter(F.col(column) >= bound if or_equal else F.col(column) > bound)


def high_value(df: DataFrame, column: str, q: float = 0.75) -> DataFrame:
    """Rows above the exact q-quantile of the column."""
    cut = exact_quantiles(df, column, [q]).first()
    return df.filter(F.col(column) > F.lit(cut["value"] if cut else None).cast("double"))


def split_label(df: DataFrame, label: str, column: str = "fraud_type") -> DataFrame:
    """``fraud`` or ``non-fraud`` rows; a missing label counts as fraud."""
    if label not in ("fraud", "non-fraud"):
        raise ValueError(f"unknown label {label!r}")
    return df.filter(C.is_fraud(column) if label == "fraud" else F.col(column) == S.NO_FRAUD)


def normalise(
    df: DataFrame, column: str, synonyms: Mapping[str, str] = S.CATEGORY_SYNONYMS
) -> DataFrame:
    return df.withColumn(column, C.normalised(column, synonyms))


def case_when(df: DataFrame, rules: Mapping[str, Callable[[], Column] | Column]) -> DataFrame:
    """Set several conditional columns at once: each rule sees the old values."""
    return df.withColumns({k: v if isinstance(v, Column) else v() for k, v in rules.items()})


def classify_flow(
    df: DataFrame, incoming_text: str = S.INCOMING_TEXT, name: str = "tx_type"
) -> DataFrame:
    return df.withColumn(name, C.flow_type("category", "description", incoming_text))


def relabel_flag(df: DataFrame, column: str = "customer_scammed") -> DataFrame:
    return df.withColumn(column, C.flag_text(column))


def adjust_amount(
    df: DataFrame,
    amount: str = "amount",
    factor: str = "factor_increase",
    name: str = "new_amount",
) -> DataFrame:
    return df.withColumn(name, C.adjusted_amount(amount, factor))


def scale_by_entity(
    df: DataFrame,
    entity: str = "customer_id",
    low: float = 0.1,
    high: float = 0.5,
    column: str = "amount",
    salt: str = "scale",
    seed: int = SEED,
) -> DataFrame:
    """Multiply by a factor drawn per entity; drawn in place, so without a join."""
    return df.withColumn(column, F.col(column) * draw_uniform(low, high, entity, salt=salt, seed=seed))
