"""Repeatable draws.

Each value is a hash of row keys, a salt and a seed, never ``rand()``: the same
row draws the same value under any partitioning, after any retry, and in any
SQL engine with md5.  Keys should be integers, strings or dates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
_HEX_DIGITS = 13  # 52 bits, so the quotient below is exact in a double
_UNITS = float(1 << 52)
_FIRST_TRIES = 2
_ALL_TRIES = 32


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _digest(keys, salt: str, seed: int) -> Column:
    parts = [as_column(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", F.lit(f"{seed}|{salt}"), *parts))


def _unit(digest: Column, start: int) -> Column:
    digits = F.substring(digest, start, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(_UNITS)


def uniform(*keys, salt: str, seed: int = SEED) -> Column:
    """A double in [0, 1) fixed by the keys."""
    return _unit(_digest(keys, salt, seed), 1)


def draw_index(size, *keys, salt: str, seed: int = SEED) -> Column:
    """A 0-based position in a list of ``size`` items."""
    return F.floor(uniform(*keys, salt=salt, seed=seed) * size)


def draw_int(low, high, *keys, salt: str, seed: int = SEED) -> Column:
    """An integer in [low, high], both ends included."""
    low, high = _bound(low), _bound(high)
    return low + F.floor(uniform(*keys, salt=salt, seed=seed) * (high - low + 1))


def draw_uniform(low, high, *keys, salt: str, seed: int = SEED) -> Column:
    """A double in [low, high)."""
    low, high = _bound(low), _bound(high)
    return low + (high - low) * uniform(*keys, salt=salt, seed=seed)


def draw_choice(values: Sequence, *keys, salt: str, seed: int = SEED) -> Column:
    """One of a short literal list."""
    options = F.array(*[F.lit(v) for v in values])
    position = draw_index(F.lit(len(values)), *keys, salt=salt, seed=seed)
    return F.element_at(options, (position + 1).cast("int"))


def draw_date(start, end, *keys, salt: str, seed: int = SEED) -> Column:
    """A day in [start, end]."""
    start, end = as_column(start), as_column(end)
    days = F.date_diff(end, start) + 1
    return F.date_add(start, draw_index(days, *keys, salt=salt, seed=seed).cast("int"))


def draw_truncated_normal(
    low, high, mean, *keys, salt: str, seed: int = SEED
) -> Column:
    """A normal value strictly inside (low, high), with deviation (high - low) / 4.

    Box-Muller on two uniforms of one md5, first accepted try of 32.  The first
    tries are plain expressions, which compile; most rows accept one of them,
    so the loop over the later ones is seldom entered.  Equal bounds give that
    value, a missing bound or mean gives none, and a row whose tries all miss
    (its mean is far outside the bounds) is an error.
    """
    low, high, mean = as_column(low), as_column(high), as_column(mean)
    spread = (high - low) / F.lit(4.0)

    def value(attempt):
        digest = _digest([*keys, attempt], salt, seed)
        radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _unit(digest, 1)))
        turn = F.cos(F.lit(2 * math.pi) * _unit(digest, 1 + _HEX_DIGITS))
        return mean + spread * (radius * turn)

    def inside(x):
        return (x > low) & (x < high)

    first = [F.when(inside(x), x) for x in map(value, map(F.lit, range(_FIRST_TRIES)))]
    later = F.transform(F.sequence(F.lit(_FIRST_TRIES), F.lit(_ALL_TRIES - 1)), value)
    found = F.coalesce(*first, F.try_element_at(F.filter(later, inside), F.lit(1)))
    unknown = low.isNull() | high.isNull() | mean.isNull()
    missed = F.raise_error(F.lit("no draw between the bounds")).cast("double")
    return F.when(unknown, F.lit(None).cast("double")).when(low == high, low.cast("double")).otherwise(F.coalesce(found, missed))


def _bound(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
