"""Exact and approximate quantiles, and histograms, without sorting the whole column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from txlab.sources.staging import stage

#: Ranges of equal size that a sketch of the values tells apart.
RANGES = 10_000
#: Different values that the last pass may bring to the driver.
MOST_VALUES = 1 << 16
#: Ranges on each side of a rank between which it is looked for; the sketch is off by one at most.
_MARGIN = 2


def _finite(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("v")).filter(F.col("v").isNotNull() & (F.abs("v") < F.lit(math.inf)))


def _pass(frame: DataFrame) -> list[Row]:
    """One reading of the values; what comes back is bounded."""
    return frame.collect()


@dataclass
class _Rank:
    """Where the values of ranks ``first`` to ``last`` lie: between ``low`` and ``high``, after ``before`` others."""

    first: int
    last: int
    low: float = -math.inf
    high: float = math.inf
    before: int = 0
    inside: int = 0
    margin: float = 0.0

    def shares(self) -> list[float]:
        """The bounds to ask a sketch of the values inside for, as shares of them."""
        low = (self.first - self.before) / self.inside - self.margin
        high = (self.last + 1 - self.before) / self.inside + self.margin
        return [max(low, 0.0), min(high, 1.0)]

    def narrow(self, shares: Sequence[float], values: Sequence[float]) -> None:
        """Take the sketch's values at the shares as bounds; the least and the largest value stay open."""
        self.low = values[0] if shares[0] > 0 else self.low
        self.high = values[1] if shares[1] < 1 else self.high
        self.inside = math.ceil(self.inside * (shares[1] - shares[0] + _MARGIN / RANGES)) + 1

    def missed(self) -> None:
        """The sketch was off by more than it says: start over with wider bounds."""
        if self.margin >= 0.1:
            raise ArithmeticError("the sketch doesn't bound the quantile")
        self.low, self.high, self.before, self.margin = -math.inf, math.inf, 0, 4 * self.margin


def _sketch(values: DataFrame, ranks: Sequence[_Rank]) -> None:
    """Narrow the bounds of all ranks in one pass."""
    inside = [F.when(F.col("v").between(r.low, r.high), F.col("v")) for r in ranks]
    found = [F.percentile_approx(v, r.shares(), RANGES).alias(f"s{i}") for i, (v, r) in enumerate(zip(inside, ranks))]
    row = _pass(values.agg(*found))[0]
    for rank, at in zip(ranks, row):
        rank.narrow(rank.shares(), at)


def _count(values: DataFrame, ranks: Sequence[_Rank], n: int) -> None:
    """Count what lies before and between the bounds of all ranks in one pass."""
    counts = []
    for i, rank in enumerate(ranks):
        counts.append(F.count_if(F.col("v") < rank.low).alias(f"b{i}"))
        counts.append(F.count_if(F.col("v").between(rank.low, rank.high)).alias(f"n{i}"))
    row = _pass(values.agg(*counts))[0]
    for i, rank in enumerate(ranks):
        rank.before, rank.inside = row[f"b{i}"], row[f"n{i}"]
        if not rank.before <= rank.first <= rank.last < rank.before + rank.inside:
            rank.missed()
            rank.inside = n


def _read(values: DataFrame, ranks: Sequence[_Rank], n: int) -> dict[int, float]:
    """The values at ranks with few values between their bounds, in one pass; others go on."""
    at = F.array(
        *[
            F.when(F.col("v") <= r.high, F.struct(F.lit(i).alias("i"), F.when(F.col("v") >= r.low, F.col("v")).alias("v")))
            for i, r in enumerate(ranks)
        ]
    )
    rows = _pass(values.select(F.explode(F.array_compact(at)).alias("at")).groupBy("at.i", "at.v").agg(F.count("*").alias("n")))
    found: dict[int, float] = {}
    for i, rank in enumerate(ranks):
        own = [(r["v"], r["n"]) for r in rows if r["i"] == i]
        upto = sum(k for v, k in own if v is None)
        within = rank.first >= upto
        for value, k in sorted((v, k) for v, k in own if v is not None):
            if within:
                found.update({r: value for r in (rank.first, rank.last) if upto <= r < upto + k})
            upto += k
        if not within or upto <= rank.last:
            rank.missed()
            rank.inside = n
    return found


def _values_at(values: DataFrame, ranks: list[_Rank], n: int) -> dict[int, float]:
    """The values at 0-based ranks of the sorted column, whatever their distribution.

    A sketch bounds each rank to some ten-thousandths of the values. Where these
    are few, the last pass counts them one by one; else they are counted and
    sketched again. So up to a hundred million values take one pass after the
    first sketch, up to a thousand times as many take three. A pass reads one
    column; nothing is put in order.
    """
    found: dict[int, float] = {}
    while ranks:
        many = [r for r in ranks if r.inside > MOST_VALUES and r.low < r.high]
        if many:
            _count(values, many, n)
            _sketch(values, many)
        else:
            found.update(_read(values, ranks, n))
            ranks = [r for r in ranks if r.first not in found or r.last not in found]
    return found


def exact_quantiles(
    df: DataFrame, column: str, quantiles: Sequence[float], written: bool = False
) -> DataFrame:
    """Linearly interpolated quantiles: one row (q, value) each, none for a column without values.

    Missing and non-finite values are left out.  Each pass reads the column
    again, so it is written first, unless ``df`` is a ``written`` table itself.
    """
    spark = df.sparkSession
    values = _finite(df, column) if written else stage(_finite(df, column))
    asked, margin = [float(q) for q in quantiles], _MARGIN / RANGES
    shares = [[max(q - margin, 0.0), min(q + margin, 1.0)] for q in asked]
    sketch = F.percentile_approx("v", [s for pair in shares for s in pair], RANGES)
    start = _pass(values.agg(F.count("*").alias("n"), sketch.alias("at")))[0]
    rows, n = [], start["n"]
    if n:
        places = [q * (n - 1) for q in asked]
        ranks = [_Rank(math.floor(p), math.ceil(p), inside=n, margin=margin) for p in places]
        for i, rank in enumerate(ranks):
            rank.narrow(shares[i], start["at"][2 * i : 2 * i + 2])
        at = _values_at(values, ranks, n)
        for q, place in zip(asked, places):
            low, high = at[math.floor(place)], at[math.ceil(place)]
            rows.append((q, low + (high - low) * (place - math.floor(place))))
    return spark.createDataFrame(rows, "q double, value double")


def approximate_quantiles(
    df: DataFrame, column: str, quantiles: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """Values whose rank is within n / accuracy of the quantile's, from one mergeable sketch."""
    asked = [float(q) for q in quantiles]
    sketch = _finite(df, column).agg(F.percentile_approx("v", asked, accuracy).alias("values"))
    pairs = F.arrays_zip(F.array(*[F.lit(q) for q in asked]).alias("q"), F.col("values").alias("value"))
    return sketch.filter("values IS NOT NULL").select(F.inline(pairs))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins over [min, max]; the last bin is closed, empty bins show 0."""
    spark = df.sparkSession
    ends = df.agg(
        F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")
    ).first()
    start, end = ends["low"], ends["high"]
    if start is not None and start == end:
        # One single value: a unit range around it.
        start, end = start - 0.5, end + 0.5
    low = F.lit(start).cast("double")
    width = (F.lit(end).cast("double") - low) / F.lit(float(bins))
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(place.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        spark.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_from"),
            (low + (F.col("bin") + 1) * width).alias("bin_to"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))
