"""Hard negatives by threshold joins over an inverted index with norm bounds.

Each anchor first looks for its positives, then, for each positive, for the
best rows of other labels whose score lies in a window below the positive's.
Both are the same search: windows of scores, each to be filled with its k best.

Anchors and vectors are packed into blocks and meet in tiles, a group of anchor
blocks with a part of the vector blocks, dealt out by a shuffle. The anchors are
the small side: they are copied to every part, the vectors to the few groups of
anchors. In a tile a threshold join gives all pairs from a score on. Dimensions
stand in ascending order of energy and in slices; the leading slices of a vector
stay out of the inverted index as long as the anchors' norm times the vector's
norm there is below the least threshold, for then no vector can reach it by them
alone. Partial scores are accumulated slice by slice from the last one; pairs
are dropped once their partial score plus the product of the remaining norms is
below the anchor's threshold, and the rest are scored exactly. Thresholds start
high and are lowered for anchors with unfilled windows until these are full or
reach their lower ends; a full window's k-th score is its threshold from then on.

Parts are searched in rounds, each eight times as many as before, and windows
that are full go on with the thresholds of all earlier rounds, so that what
tiles return doesn't grow with the number of parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.llm.vectors import ENDLESS, EXACT, blocks, fill, part_of, parts_of, tile, windows_of
from txlab.sources.staging import stage

SCALE = 256.0
#: Bytes of vectors and of anchors that a tile holds.
PART_BYTES = 1 << 24
ASKED_BYTES = 1 << 24
SLICE = 8
#: A part's first vectors are few, as thresholds are still low; the next ones are taken in chunks.
CHUNKS = (512, 4_096)
ANCHORS_AT_ONCE = 512
#: Shares of a window, from its upper end, to which thresholds are lowered.
LOWERED = (0.15, 0.3, 0.45, 0.6, 1.0)
#: Share of pairs under which the rest of the dimensions is added pair by pair.
_FEW = 0.02
_PAIRS_AT_ONCE = 1 << 17
#: Scores times 100 must fit in 64 bits.
_MOST = 2.0**56


class Vectors:
    """Vectors whose dimensions are cut into slices, and the norms of what lies before each cut."""

    def __init__(self, values: np.ndarray, order: np.ndarray):
        self.exact = values
        self.values = values[:, order].astype(np.float64)
        self.cuts = [*range(0, values.shape[1], SLICE), values.shape[1]]
        squares = np.cumsum(self.values * self.values, axis=1)
        before = np.concatenate((np.zeros((len(values), 1)), squares), axis=1)
        self.norms = np.sqrt(before[:, self.cuts])

    def take(self, rows) -> "Vectors":
        out = object.__new__(Vectors)
        out.exact, out.values, out.cuts, out.norms = self.exact[rows], self.values[rows], self.cuts, self.norms[rows]
        return out


def energy_order(values: np.ndarray) -> np.ndarray:
    return np.argsort((values.astype(np.float64) ** 2).sum(axis=0), kind="stable")


def join(asked: Vectors, held: Vectors, least: np.ndarray, seen: dict | None = None) -> tuple[np.ndarray, ...]:
    """Row of ``asked``, row of ``held`` and score of all pairs that score ``least`` of their asked row, or more.

    ``seen`` counts the pairs and those that were scored exactly.
    """
    top = float(np.abs(asked.values).max(initial=0)) * float(np.abs(held.values).max(initial=0)) * max(asked.values.shape[1], 1)
    if top >= _MOST:
        raise ArithmeticError("a score times 100 may not fit in 64 bits")
    if top >= EXACT:
        scores = asked.exact.astype(np.int64) @ held.exact.astype(np.int64).T
        x, y = np.nonzero(scores >= least[:, None])
        return x, y, scores[x, y]
    least = least.astype(np.float64)
    slices = len(held.cuts) - 1
    # What no anchor's norm can lift to the least threshold is not indexed.
    lift = held.norms * asked.norms[:, -1].max(initial=0) * (1 + 1e-9)
    left_out = np.maximum((lift < least.min(initial=np.inf)).sum(axis=1) - 1, 0)
    order = np.argsort(left_out, kind="stable")
    left_out, values, norms = left_out[order], held.values[order], held.norms[order]
    partial = np.zeros((len(asked.values), len(values)))
    near = None
    for k in reversed(range(slices)):
        indexed = np.searchsorted(left_out, k, side="right")
        part = slice(held.cuts[k], held.cuts[k + 1])
        partial[:, :indexed] += asked.values[:, part] @ values[:indexed, part].T
        if k in (slices // 4, slices // 2, 0):
            rest = np.maximum(left_out, k)
            bound = partial + asked.norms[:, rest] * norms[np.arange(len(values)), rest]
            near = bound * (1 + 1e-9) + 1e-6 * (1 + np.abs(bound)) >= least[:, None]
            if k and near.mean() < _FEW:
                break
    if near is None:  # vectors without dimensions
        near = partial >= least[:, None]
    x, y = np.nonzero(near)
    if seen is not None:
        seen["pairs"] = seen.get("pairs", 0) + near.size
        seen["exact"] = seen.get("exact", 0) + len(x)
    scores = np.empty(len(x))
    for start in range(0, len(x), _PAIRS_AT_ONCE):
        some = slice(start, start + _PAIRS_AT_ONCE)
        scores[some] = np.einsum("pd,pd->p", asked.values[x[some]], values[y[some]])
    kept = scores >= least[x]
    return x[kept], order[y[kept]], scores[kept].astype(np.int64)


class _Windows:
    """Windows of scores of some anchors, and the best rows found for each so far."""

    def __init__(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.anchor, self.low, self.high, self.k = anchor, low.copy(), high, k
        self.found = tuple(np.empty(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        window, ids, scores = (np.concatenate(both) for both in zip(self.found, (window, ids, scores)))
        order = np.lexsort((ids, -scores, window))
        window, ids, scores = window[order], ids[order], scores[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        last = rank == self.k - 1
        self.low[window[last]] = scores[last]
        kept = rank < self.k
        self.found = window[kept], ids[kept], scores[kept]

    def filled(self) -> np.ndarray:
        return np.bincount(self.found[0], minlength=len(self.low)) >= self.k


def _search_chunk(windows: _Windows, anchors: dict, held: dict, same: bool) -> None:
    """Add what a chunk of vectors has for the windows, with thresholds lowered until they are full."""
    reach = anchors["vectors"].norms[:, -1] * held["vectors"].norms[:, -1].max(initial=0)
    reach = np.ceil(np.minimum(reach * (1 + 1e-9) + 1, float(ENDLESS))).astype(np.int64)[windows.anchor]
    upper, lower = np.minimum(windows.high, reach), np.maximum(windows.low, -reach)
    todo, above = lower <= upper, upper + 1
    for share in LOWERED:
        if not todo.any():
            return
        full = windows.filled()
        span = (upper - lower).astype(np.float64)
        down = np.where(full, lower, np.maximum(lower, upper - np.ceil(share * span).astype(np.int64)))
        down = lower if share == LOWERED[-1] else down
        active = np.flatnonzero(todo)
        rows, where = np.unique(windows.anchor[active], return_inverse=True)
        least = np.full(len(rows), np.iinfo(np.int64).max)
        np.minimum.at(least, where, down[active])
        x, y, scores = join(anchors["vectors"].take(rows), held["vectors"], least)
        fits = (held["labels"][y] == anchors["labels"][rows[x]]) == same
        fits &= held["ids"][y] != anchors["ids"][rows[x]]
        x, y, scores = x[fits], y[fits], scores[fits]
        # The windows of an anchor stand together.
        first = np.searchsorted(where, np.arange(len(rows)))
        count = np.bincount(where, minlength=len(rows))
        for k in range(int(count.max())):
            has = k < count[x]
            window = active[first[x[has]] + k]
            inside = (scores[has] >= down[window]) & (scores[has] < above[window])
            windows.add(window[inside], held["ids"][y[has]][inside], scores[has][inside])
        above = np.where(todo, down, above)
        # Earlier chunks may have filled a window by rows below this threshold: the chunk is searched down to the k-th score.
        lower = np.maximum(lower, windows.low)
        todo &= down > lower


def _some(held: dict, rows: slice, order: np.ndarray) -> dict:
    return {"ids": held["vec_id"][rows], "labels": held["label"][rows], "vectors": Vectors(held["values"][rows], order)}


def _chunks(held: dict, order: np.ndarray) -> Iterator[dict]:
    start, sizes = 0, [*CHUNKS]
    while start < len(held["vec_id"]):
        rows = slice(start, start + (sizes.pop(0) if len(sizes) > 1 else sizes[0]))
        yield _some(held, rows, order)
        start = rows.stop


def _search(k: int, same: bool):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        vectors = tile(right)
        for dim, asked in tile(left).items():
            if dim not in vectors:
                continue
            order = energy_order(vectors[dim]["values"])
            place, number, at, slot, low, high = windows_of(asked)
            chunks = list(_chunks(vectors[dim], order))
            for start in range(0, len(asked["vec_id"]), ANCHORS_AT_ONCE):
                rows = slice(start, start + ANCHORS_AT_ONCE)
                own = slice(*np.searchsorted(place, (rows.start, rows.stop)))
                anchors = _some(asked, rows, order)
                windows = _Windows(place[own] - start, low[own], high[own], k)
                for chunk in chunks:
                    _search_chunk(windows, anchors, chunk, same)
                window, ids, scores = windows.found
                for column, values in zip(out, (number[own][window], at[own][window], slot[own][window], ids, scores)):
                    column.append(values)
        columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, ["number", "at", "slot", "vec_id", "score"])

    return run


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, exactly.

    Rows have ``vec_id, embedding, label``; components count as floor(256 * x),
    the score is the inner product, higher ones come first, ties by smaller
    vec_id. Anchors are the rows whose vec_id is divisible by ``every``, their
    positives the first other rows with the same label. For each positive the
    first rows of other labels are returned that score ``least_percent`` to
    ``most_percent`` of it; none does for a positive with a score below 0.

    Rows without vec_id or label, and those whose vector is null or has a null
    or non-finite component, take no part. Vectors of different lengths don't
    meet; empty ones score 0 with each other. Rows that share a vec_id stay
    apart: each anchor row has results of its own, each row counts as a positive
    or negative, but not for an anchor with its vec_id. Fewer rows than asked for
    are all returned; an empty table gives none. Scores whose hundredfold may not
    fit in 64 bits are an error.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL")
    facts = ["vec_id", "label"]
    asked = blocks(rows.filter(F.col("vec_id") % every == 0), SCALE, facts)
    held = blocks(rows, SCALE, facts)
    tasks = 2 * embeddings.sparkSession.sparkContext.defaultParallelism
    asks, parts = parts_of(asked, ASKED_BYTES), parts_of(held, PART_BYTES, tasks)
    held = held.withColumn("part", part_of(F.col("number"), parts)).drop("number")
    ids = asked.select("number", F.posexplode("vec_id").alias("at", "anchor_id"))
    whole = ids.select("number", "at", F.lit(0).alias("slot"), F.lit(-ENDLESS).alias("low"), F.lit(ENDLESS).alias("high"))
    own = fill(whole, asked, asks, held, parts, positives, _search(positives, True)).select(
        "number",
        "at",
        F.col("rank").alias("slot"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    own = stage(own)
    low = F.expr(f"(positive_score * {least_percent} + pmod(-positive_score * {least_percent}, 100L)) div 100")
    high = F.expr(f"(positive_score * {most_percent} - pmod(positive_score * {most_percent}, 100L)) div 100")
    windows = own.filter("positive_score >= 0").select("number", "at", "slot", low.alias("low"), high.alias("high"))
    others = fill(stage(windows), asked, asks, held, parts, negatives, _search(negatives, False))
    best = others.select("number", "at", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(own, ["number", "at", "slot"]).join(ids, ["number", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
