"""Exact top-k search by inner product, pruned by segment statistics.

A vector cut into segments has a mean and a deviation for each; for segments of
length l the squared distance of two vectors is at least the sum of
l * ((mean - mean')^2 + (dev - dev')^2), so their inner product is at most the
sum of l * (mean * mean' + dev * dev'). Bounds are taken with few segments
first, then with more for the pairs that may still be among a query's best; only
pairs whose own bounds reach the k-th best score so far are scored exactly. Where
there aren't k yet, the vectors whose means are most like the query's come first.

Vectors and queries are packed into blocks and meet in tiles, dealt out by a
shuffle: a group of query blocks with a part of the vector blocks. Queries are
the small side and copied to every part, vectors to the few groups of queries.
Parts are searched in rounds that start from the scores reached so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.llm.vectors import ENDLESS, EXACT, blocks, fill, part_of, parts_of, tile, windows_of

SCALE = 64.0
#: Bytes of vectors and of queries that a tile holds.
PART_BYTES = 1 << 24
ASKED_BYTES = 1 << 24
#: Vectors and queries that are compared at once.
CHUNK = 4_096
QUERIES_AT_ONCE = 256
SEGMENTS = (1, 4, 16)
#: Of a query without k rows yet, so many times k of the likeliest vectors are scored first.
FIRST = 4
#: Share of pairs above which a whole matrix is computed instead of single pairs.
_MANY = 0.1
_PAIRS_AT_ONCE = 1 << 17


class Chunk:
    """Vectors with their ids and, for each resolution, the means and deviations of their segments."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values, self.numbers = ids, values, values.astype(np.float64)
        self.most = float(np.abs(self.numbers).max(initial=0))
        self.levels = [_statistics(values, s) for s in SEGMENTS if s <= values.shape[1]]


def _statistics(values: np.ndarray, segments: int) -> np.ndarray:
    """Mean and deviation of each segment, times the square root of its length."""
    cuts = np.linspace(0, values.shape[1], segments + 1).astype(int)
    out = []
    for low, high in zip(cuts, cuts[1:]):
        part = values[:, low:high].astype(np.float64)
        root = np.sqrt(high - low)
        out += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(out, axis=1)


def _of_pairs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of rows x of a with rows y of b."""
    out = np.empty(len(x))
    for start in range(0, len(x), _PAIRS_AT_ONCE):
        some = slice(start, start + _PAIRS_AT_ONCE)
        out[some] = np.einsum("pd,pd->p", a[x[some]], b[y[some]])
    return out


def _fits(asked: Chunk, held: Chunk) -> bool:
    """Whether scores are exact in floating point; otherwise they are computed as 64-bit numbers."""
    most = asked.most * held.most * max(asked.values.shape[1], 1)
    if most >= 2.0**62:
        raise ArithmeticError("a score may not fit in 64 bits")
    return most < EXACT


class _Best:
    """The k best ids of each query so far and the score to reach; ties go to the smaller id."""

    def __init__(self, low: np.ndarray, k: int):
        self.k, self.low = k, low.copy()
        self.found = tuple(np.empty(0, np.int64) for _ in range(3))

    @property
    def rows(self) -> int:
        return len(self.found[0])

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        reached = scores >= self.low[query]
        query, ids, scores = (np.concatenate((old, new[reached])) for old, new in zip(self.found, (query, ids, scores)))
        order = np.lexsort((-scores, ids, query))  # an id that occurs again counts once, with its best score
        query, ids, scores = query[order], ids[order], scores[order]
        fresh = np.ones(len(query), bool)
        fresh[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, scores = query[fresh], ids[fresh], scores[fresh]
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.k - 1
        self.low[query[last]] = np.maximum(self.low[query[last]], scores[last])
        kept = rank < self.k
        self.found = query[kept], ids[kept], scores[kept]


def scan(best: _Best, asked: Chunk, held: Chunk, seen: dict | None = None) -> None:
    """Add what a chunk of vectors has for the queries. ``seen`` counts the pairs and those scored exactly.

    While many pairs are alive, whole matrices are computed; then single pairs.
    """
    fits = _fits(asked, held)
    alive = asked.ids[:, None] != held.ids[None, :]
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    bound = np.zeros(alive.shape)
    slack = 1e-6 + 1e-9 * asked.most * held.most * asked.values.shape[1]

    def few() -> tuple[np.ndarray, np.ndarray] | None:
        return None if np.count_nonzero(alive) > _MANY * alive.size else np.nonzero(alive)

    def score(x: np.ndarray, y: np.ndarray) -> None:
        if fits:
            scores = _of_pairs(asked.numbers, held.numbers, x, y).astype(np.int64)
        else:
            scores = (asked.values.astype(np.int64) @ held.values.astype(np.int64).T)[x, y]
        best.add(x, held.ids[y], scores)

    for own, theirs in zip(asked.levels, held.levels):
        if pairs is None:
            bound = own @ theirs.T + slack
            alive &= bound >= best.low[:, None]
            pairs = few()
        else:
            x, y = pairs
            near = _of_pairs(own, theirs, x, y) + slack >= best.low[x]
            pairs = x[near], y[near]
    counted = 0
    if pairs is None and best.rows < best.k * len(asked.ids):
        # The deviations only bound what the means tell.
        likely = asked.levels[-1][:, ::2] @ held.levels[-1][:, ::2].T if asked.levels else np.zeros(alive.shape)
        some = min(FIRST * best.k, alive.shape[1])
        x, y = np.repeat(np.arange(len(likely)), some), np.argpartition(-likely, some - 1, axis=1)[:, :some].ravel()
        live = alive[x, y]
        score(x[live], y[live])
        counted += int(live.sum())
        alive[x, y] = False
        alive &= (bound >= best.low[:, None]) | (not asked.levels)
        pairs = few()
    if pairs is not None:
        score(*pairs)
        counted += len(pairs[0])
    elif fits:
        scores = asked.numbers @ held.numbers.T
        counted += int(np.count_nonzero(alive))
        x, y = np.nonzero(alive & (scores >= best.low[:, None]))
        best.add(x, held.ids[y], scores[x, y].astype(np.int64))
    else:
        counted += int(np.count_nonzero(alive))
        score(*np.nonzero(alive))
    if seen is not None:
        seen["pairs"] = seen.get("pairs", 0) + alive.size
        seen["exact"] = seen.get("exact", 0) + counted


def _search(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        vectors = tile(right)
        for dim, asked in tile(left).items():
            if dim not in vectors:
                continue
            held = vectors[dim]
            chunks = [
                Chunk(held["vec_id"][start : start + CHUNK], held["values"][start : start + CHUNK])
                for start in range(0, len(held["vec_id"]), CHUNK)
            ]
            _, number, at, slot, low, _ = windows_of(asked)  # one window a query
            for start in range(0, len(number), QUERIES_AT_ONCE):
                rows = slice(start, start + QUERIES_AT_ONCE)
                queries, best = Chunk(asked["vec_id"][rows], asked["values"][rows]), _Best(low[rows], k)
                for chunk in chunks:
                    scan(best, queries, chunk)
                query, ids, scores = best.found
                for column, values in zip(out, (number[rows][query], at[rows][query], slot[rows][query], ids, scores)):
                    column.append(values)
        columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, ["number", "at", "slot", "vec_id", "score"])

    return run


def top_k(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best vectors of each query, exactly.

    Queries are rows whose ``vec_id`` is divisible by ``every``; all other rows
    of the table are their candidates. Components count as floor(64 * x), the
    score is the inner product, ties go to the smaller vec_id, ranks start at 1.

    Rows without vec_id or vector, and vectors with a null or non-finite
    component, take no part. Vectors of different lengths don't meet; empty ones
    score 0 with each other. A vec_id that occurs several times is returned once
    for a query, with its best score, and isn't its own candidate; its queries
    are one. With fewer than k candidates all are returned; an empty table gives
    no rows. Components and scores that may not fit in 62 bits are an error.
    Other columns aren't read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding").filter("vec_id IS NOT NULL")
    asked = blocks(rows.filter(F.col("vec_id") % every == 0), SCALE, ["vec_id"])
    held = blocks(rows, SCALE, ["vec_id"])
    tasks = 2 * embeddings.sparkSession.sparkContext.defaultParallelism
    asks, parts = parts_of(asked, ASKED_BYTES), parts_of(held, PART_BYTES, tasks)
    held = held.withColumn("part", part_of(F.col("number"), parts)).drop("number")
    ids = asked.select("number", F.posexplode("vec_id").alias("at", "query_id"))
    whole = ids.select("number", "at", F.lit(0).alias("slot"), F.lit(-ENDLESS).alias("low"), F.lit(ENDLESS).alias("high"))
    found = fill(whole, asked, asks, held, parts, k, _search(k), once=True)
    # The rows of a repeated query are one.
    found = found.join(ids, ["number", "at"]).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
