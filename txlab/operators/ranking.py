"""Ranking and fraction sampling inside groups of any size.

A plain window sorts each group in one task, which fails when one group holds
a third of all rows.  Here all rows are dealt out by ranges of (group, order)
and put in order there, so a group of any size is spread over as many parts as
it fills.  A row is numbered in its part as it is written; its rank is that
number less that of the group's first row there, plus the group's rows in earlier
parts.  Both are hash aggregates of one number for each group and part.  There is
one plan for all sizes.

Where most groups are tiny, these numbers are about as many as the rows.  With
``small`` groups are counted first, those of at most so many rows are ranked by a
window, without being written, and only the others, if there are any, by ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlab.functions.draws import SEED, uniform
from txlab.sources.staging import stage

#: Rows of a group that one task may well put in order.
SMALL = 100_000
_GROUP = "_group"
_ORDER = "_order"
_PART = "_part"
_ID = "_id"
#: The upper bits of a row's id are its part, these lower ones its number there.
_PART_BITS = 33


def group_key(by: Sequence[str]) -> Column:
    """The group as one struct: unlike its fields, it equals itself also where one is null."""
    return F.struct(*[F.col(c) for c in by]) if by else F.lit(0)


def _ranked(
    df: DataFrame, by: Sequence[str], key: Sequence[str], prefix: Sequence[str], salt: str, name: str, seed: int
) -> DataFrame:
    """The rows with their ``name``, 1 for the first of its group, and ``_size``, the group's rows."""
    by, order = list(by), [*prefix, _ORDER, *key]
    dealt = df.withColumns({_GROUP: group_key(by), _ORDER: uniform(*key, salt=salt, seed=seed)})
    ordered = dealt.repartitionByRange(_GROUP, *order).sortWithinPartitions(_GROUP, *order)
    rows = stage(ordered.drop(_GROUP, _ORDER).withColumn(_ID, F.monotonically_increasing_id()))
    part = F.shiftright(_ID, _PART_BITS).alias(_PART)
    here = rows.groupBy(group_key(by).alias(_GROUP), part).agg(F.min(_ID).alias("_start"), F.count(F.lit(1)).alias("_here"))
    group = Window.partitionBy(_GROUP)
    earlier = F.sum("_here").over(group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    shift = F.coalesce(earlier, F.lit(0)) + 1 - F.col("_start")
    # Written, so that Spark knows their size and can split the rows of a hot group.
    spans = stage(here.select(_GROUP, _PART, shift.alias("_shift"), F.sum("_here").over(group).alias("_size")))
    ranked = rows.withColumns({_GROUP: group_key(by), _PART: part}).join(spans, [_GROUP, _PART])
    return ranked.select(*[F.col(c) for c in df.columns], (F.col(_ID) + F.col("_shift")).alias(name), "_size")


def _ranked_by_window(
    df: DataFrame, by: Sequence[str], key: Sequence[str], prefix: Sequence[str], salt: str, name: str, seed: int
) -> DataFrame:
    """The same by a plain window, without the sizes."""
    ordered = df.withColumn(_ORDER, uniform(*key, salt=salt, seed=seed))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*prefix, _ORDER, *key)).cast("long")
    return ordered.select(*[F.col(c) for c in df.columns], place.alias(name))


def rank_in_group(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    prefix: Sequence[str] = (),
    salt: str = "rank",
    name: str = "rank",
    seed: int = SEED,
    small: int = 0,
) -> DataFrame:
    """1-based ``row_number`` per group, ordered by ``prefix``, then hash of ``key``, then ``key``.

    ``key`` must be unique in the group.  Groups of up to ``small`` rows are ranked in one task each.
    """
    rest = (by, key, prefix, salt, name, seed)
    if not small or not by:
        return _ranked(df, *rest).drop("_size")
    sizes = df.groupBy(group_key(by).alias(_GROUP)).agg(F.count(F.lit(1)).alias("_size"))
    large = stage(sizes.filter(F.col("_size") > small).select(_GROUP))
    if large.isEmpty():
        return _ranked_by_window(df, *rest)
    keyed = df.withColumn(_GROUP, group_key(by))
    few, many = (keyed.join(large, _GROUP, how).select(*[F.col(c) for c in df.columns]) for how in ("left_anti", "left_semi"))
    return _ranked_by_window(few, *rest).unionByName(_ranked(many, *rest).drop("_size"))


def mark_lowest(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    limit: Callable[[Column], Column],
    salt: str,
    name: str = "picked",
    seed: int = SEED,
) -> DataFrame:
    """Flag the ``limit(group size)`` rows of each group with the lowest key hash."""
    ranked = _ranked(df, by, key, (), salt, "_rank", seed)
    return ranked.select(*[F.col(c) for c in df.columns], (F.col("_rank") <= limit(F.col("_size"))).alias(name))
