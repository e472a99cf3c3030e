"""Calendar expressions on date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlab.functions.draws import as_column


def parse_date(column, pattern: str | None = None) -> Column:
    column = as_column(column)
    return F.to_date(column, pattern) if pattern else F.to_date(column)


def parse_timestamp(column, pattern: str | None = None) -> Column:
    column = as_column(column)
    return F.to_timestamp_ntz(column, F.lit(pattern)) if pattern else F.to_timestamp_ntz(column)


def month_number(column) -> Column:
    """Month of the year: the same month of two years has one number."""
    return F.month(as_column(column))


def month_start(column) -> Column:
    return F.trunc(as_column(column), "MM")


def month_end(column) -> Column:
    return F.last_day(as_column(column))


def last_friday(column) -> Column:
    """The last Friday of the date's month."""
    return F.next_day(F.date_sub(F.last_day(as_column(column)), 7), "FR")


def days_between(start, end) -> Column:
    """Every day from start to end, both included, as an array."""
    return F.sequence(as_column(start), as_column(end), F.expr("interval 1 day"))


def month_frames(start, months) -> Column:
    """``months`` frames {start, end}: the first begins on the given day, later ones on day 1."""
    start = as_column(start)
    count = months if isinstance(months, Column) else F.lit(months)

    def frame(i):
        first = F.add_months(F.trunc(start, "MM"), i)
        begin = F.when(i == 0, start).otherwise(first)
        return F.struct(begin.alias("start"), F.last_day(first).alias("end"))

    return F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), frame)
