"""Seeded sampling: the same rows under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlab.functions.draws import SEED, draw_index, uniform
from txlab.operators.ranking import mark_lowest, rank_in_group
from txlab.sources.staging import stage

_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _primes(first: int, count: int) -> tuple[int, ...]:
    found: list[int] = []
    while len(found) < count:
        if all(first % k for k in range(2, int(first**0.5) + 1)):
            found.append(first)
        first += 1
    return tuple(found)


# Steps for walking a pool without repeats: a step that shares no factor with
# the pool size visits every position once before it comes back.
STEP_PRIMES = _primes(1_000_003, 48)


def lowest_n(
    df: DataFrame, by: Sequence[str], n: int, key: Sequence[str], salt: str, name: str, seed: int = SEED
) -> DataFrame:
    """The ``n`` rows of each group with the lowest key hash, numbered from 1 as ``name``.

    As far as Spark cuts groups to a literal limit in each task, only those rows
    are shuffled; beyond that limit the rows are dealt out by rank ranges.
    """
    if n <= int(df.sparkSession.conf.get(_LIMIT)):
        window = Window.partitionBy(*by).orderBy("_order", *key)
        return (
            df.withColumn("_order", uniform(*key, salt=salt, seed=seed))
            .withColumn(name, F.row_number().over(window).cast("long"))
            .filter(F.col(name) <= n)
            .drop("_order")
        )
    return rank_in_group(df, by, key, salt=salt, name=name, seed=seed).filter(F.col(name) <= n)


def sample_n(
    df: DataFrame,
    by: Sequence[str],
    n: int,
    key: Sequence[str],
    salt: str = "sample",
    strict: bool = False,
    seed: int = SEED,
) -> DataFrame:
    """``n`` rows of each group without replacement; ``strict`` raises where a group holds fewer."""
    if strict:
        short = df.groupBy(*by).count().filter(F.col("count") < n).limit(1).count()
        if short:
            raise ValueError(f"a group holds fewer than {n} rows")
    return lowest_n(df, by, n, key, salt, "_n", seed).drop("_n")


def sample_share(df: DataFrame, share: float, key: Sequence[str], salt: str = "share", seed: int = SEED) -> DataFrame:
    """About ``share`` of the rows, each by its own key hash: a filter, without any shuffle."""
    return df.filter(uniform(*key, salt=salt, seed=seed) < share)


def sample_fraction(
    df: DataFrame,
    by: Sequence[str],
    numerator: int,
    denominator: int,
    key: Sequence[str],
    salt: str = "fraction",
    seed: int = SEED,
) -> DataFrame:
    """``floor(size * numerator / denominator)`` rows of each group, in integers."""
    marked = mark_lowest(df, by, key, integer_share(numerator, denominator), salt, "_in", seed)
    return marked.filter("_in").drop("_in")


def integer_share(numerator: int, denominator: int):
    return lambda size: F.floor(size * F.lit(numerator) / F.lit(denominator))


def select_entities(
    df: DataFrame, entity: str, share: float, salt: str = "sel", seed: int = SEED
) -> DataFrame:
    """Exactly ``floor(n * share)`` of the n distinct entities; a missing one is none."""
    entities = stage(df.select(entity).filter(F.col(entity).isNotNull()).distinct())
    marked = mark_lowest(entities, [], [entity], lambda n: F.floor(n * F.lit(share)), salt, "_in", seed)
    return marked.filter("_in").drop("_in")


def is_selected(
    df: DataFrame, entity: str, share: float, salt: str = "sel", seed: int = SEED, drawn: str | None = None
) -> Column:
    """Membership in ``select_entities`` as a filter on rows, without a join.

    The selected entities are those with the lowest hash, so the last one
    selected decides for every row.  That single value is fetched once.
    ``drawn``: a column with the rows' ``uniform`` of the entity, if it was written with them.
    """
    h, k = uniform(entity, salt=salt, seed=seed), F.col(entity)
    place = F.struct(h.alias("h"), k.alias("k"))
    last = select_entities(df, entity, share, salt, seed).agg(F.max(place).alias("p")).first()["p"]
    if last is None:
        return F.lit(False)
    h = F.col(drawn) if drawn else h
    return k.isNotNull() & (F.struct(h.alias("h"), k.alias("k")) <= F.struct(F.lit(last["h"]).alias("h"), F.lit(last["k"]).alias("k")))


@dataclass(frozen=True)
class IndexedPool:
    """A pool with 0-based positions per group, and the size of each group."""

    rows: DataFrame
    sizes: DataFrame
    on: tuple[str, ...]


def index_pool(
    pool: DataFrame,
    on: Sequence[str],
    key: Sequence[str],
    salt: str = "pool",
    seed: int = SEED,
) -> IndexedPool:
    """Number the rows of each group.

    Both tables are staged: their exact sizes let Spark broadcast them where
    they are small and shuffle them where they are not.
    """
    ranked = rank_in_group(pool, on, key, salt=salt, name="_rank", seed=seed)
    rows = stage(ranked.select(*pool.columns, (F.col("_rank") - 1).alias("_pos")))
    sizes = stage(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_pool_size")))
    return IndexedPool(rows, sizes, tuple(on))


def with_pool_size(rows: DataFrame, pool: IndexedPool, how: str = "inner") -> DataFrame:
    if pool.on:
        return rows.join(pool.sizes, list(pool.on), how)
    return rows.withColumn("_pool_size", pool.sizes.scalar())


def pick(
    rows: DataFrame,
    pool: IndexedPool,
    key: Sequence[str],
    salt: str,
    take: Sequence[str],
    how: str = "inner",
    seed: int = SEED,
) -> DataFrame:
    """Give every row one member of its group's pool, drawn with replacement.

    Rows whose group has no pool drop out, or with ``how="left"`` keep what they have.
    """
    position = draw_index(F.col("_pool_size"), *key, salt=salt, seed=seed)
    sized = with_pool_size(rows, pool, how).withColumn("_pos", position)
    return at_position(sized, pool, take, how)


def at_position(
    rows: DataFrame, pool: IndexedPool, take: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join pool members on (group, ``_pos``); drops the helper columns."""
    new = {c: f"_new_{c}" for c in take if c not in pool.on}
    members = pool.rows.select(
        *pool.on, "_pos", *[F.col(c).alias(n) for c, n in new.items()], F.lit(True).alias("_found")
    )
    joined = rows.join(members, [*pool.on, "_pos"], how)

    def value(column: str):
        taken = F.col(new[column])
        if how == "left" and column in rows.columns:
            return F.when(F.col("_found"), taken).otherwise(F.col(column))
        return taken

    kept = [c for c in rows.columns if c not in (*new, "_pos", "_pool_size")]
    return joined.select(*kept, *[value(c).alias(c) for c in new])


def distinct_position(size: Column, draw: Column, *keys, salt: str, seed: int = SEED) -> Column:
    """Position of the ``draw``-th pick of a cell: no repeats while draw < size.

    A cell's picks start at a drawn position and go on by a drawn step, the
    product of two drawn primes that don't divide the pool's size.
    """
    start = draw_index(size, *keys, salt=salt, seed=seed)
    usable = F.filter(F.array(*[F.lit(p).cast("long") for p in STEP_PRIMES]), lambda p: size % p != 0)

    def prime(number: int) -> Column:
        at = draw_index(F.size(usable), *keys, salt=f"{salt}-step{number}", seed=seed)
        return F.element_at(usable, (at + 1).cast("int"))

    step = (prime(1) * prime(2)) % size
    return (start + draw * step) % size
