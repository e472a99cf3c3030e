"""Scalar column expressions of the transaction model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions.draws import as_column

MONEY = "decimal(38,10)"


def money(column) -> Column:
    """An amount as a wide decimal, so that sums do not depend on row order.

    Ten places and 28 digits before them; nothing is rounded to pence before it is added.
    """
    return as_column(column).cast(MONEY)


def half_even(column, digits: int = 0) -> Column:
    return F.bround(as_column(column), digits)


def money_sum(column) -> Column:
    return F.sum(money(column)).cast("double")


def money_mean(column) -> Column:
    """Mean over the non-null amounts; equal under any partitioning."""
    return F.try_divide(money_sum(column), F.count(as_column(column)))


def contains_text(column, text: str) -> Column:
    return F.contains(as_column(column), F.lit(text))


def is_fraud(column="fraud_type") -> Column:
    """A missing label counts as fraud: it differs from the text of no fraud."""
    return ~as_column(column).eqNullSafe(F.lit(S.NO_FRAUD))


def case_when(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching rule wins; conditions see the values before this step."""
    expression = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        expression = (
            F.when(condition, value)
            if expression is None
            else expression.when(condition, value)
        )
    if expression is None:
        return default if isinstance(default, Column) else F.lit(default)
    return expression.otherwise(default)


def normalised(column, synonyms: Mapping[str, str] = S.CATEGORY_SYNONYMS) -> Column:
    column = as_column(column)
    return F.coalesce(F.try_element_at(literal_map(synonyms), column), column)


def literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for item in values.items() for part in item])


def flow_type(category, description, incoming_text: str = S.INCOMING_TEXT) -> Column:
    """``income`` for income categories or incoming transfers, else ``spending``.

    A missing description matches nothing, so the category decides.
    """
    earned = as_column(category).isin(*S.INCOME_CATEGORIES)
    incoming = contains_text(description, incoming_text)
    return F.when(
        F.coalesce(earned, F.lit(False)) | F.coalesce(incoming, F.lit(False)), "income"
    ).otherwise("spending")


def flag_text(flag) -> Column:
    return F.when(as_column(flag) == 1, "scammed").otherwise("not-scammed")


def adjusted_amount(amount, factor) -> Column:
    """Amounts above 2 grow by the factor, the others by 4."""
    amount, factor = as_column(amount), as_column(factor)
    return F.when(amount > 2, amount * factor).otherwise(amount + 4)


def spent_text(total) -> Column:
    return F.concat(F.lit("Spent: £"), F.format_number(as_column(total), 0), F.lit(" "))
