"""Top-k search against all pairs, and odd rows."""

import math
import random

import numpy as np
import pytest

from txlab.llm import search
from txlab.llm import vectors as vectors_of_blocks
from txlab.llm.search import top_k


def brute(rows, every, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        best = {}
        for i, v in usable:
            if i == q:
                continue
            for j, w in usable:
                if j == q and len(v) == len(w):
                    score = sum(a * b for a, b in zip(v, w))
                    best[i] = max(score, best.get(i, score))
        ranked = sorted((-s, i) for i, s in best.items())[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return out


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dim)] for _ in range(6)]
    return [(i, [float(np.float32(c + rng.gauss(0, 0.3))) for c in rng.choice(centres)]) for i in range(n)]


def got(spark, rows, **options):
    extra = ", number int, at int, slot int, score string, rank int, part int, label int"
    frame = spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5, 6) for r in rows], "vec_id long, embedding array<double>" + extra)
    return sorted(tuple(r) for r in top_k(frame, **options).collect())


@pytest.mark.parametrize(("n", "dim", "every", "k"), [(300, 64, 20, 20), (200, 5, 10, 3), (40, 17, 7, 60)])
def test_all_pairs(spark, monkeypatch, n, dim, every, k):
    for name, value in (("PART_BYTES", 2 * dim * 32), ("ASKED_BYTES", 2 * dim * 4), ("CHUNK", 16), ("QUERIES_AT_ONCE", 3)):
        monkeypatch.setattr(search, name, value)
    monkeypatch.setattr(vectors_of_blocks, "BLOCK_BYTES", 8 * dim * 4)
    rows = vectors(n, dim, n)
    assert got(spark, rows, every=every, k=k) == brute(rows, every, k)


def test_odd_rows(spark):
    rows = vectors(60, 4, 9) + [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan")] * 4), (103, [float("inf")] * 4)]
    rows += [(104, [0.5, 0.25]), (120, [-1.0, 2.0]), (106, []), (140, []), (None, [1.0] * 4)]
    rows += [(200, [9.0] * 4), (200, [9.0] * 4), (201, [9.0] * 4), (201, [1.0] * 4), (202, [9.0] * 4), (203, [1e6, 0.0, 0.0, -1e6])]
    assert got(spark, rows, every=20, k=5) == brute(rows, 20, 5)
    assert got(spark, [], every=20, k=5) == []
    assert got(spark, [(1, [1.0])], every=20, k=5) == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(30, 37)), rng.normal(size=(40, 37))
    exact, last = a @ b.T, np.inf
    for segments in (1, 2, 4, 8, 16):
        bound = search._statistics(a, segments) @ search._statistics(b, segments).T
        assert (bound >= exact - 1e-9).all()
        assert bound.mean() <= last
        last = bound.mean()


def test_large_numbers(spark):
    rows = [(0, [2.0**24, 1.0]), (1, [3.0, 2.0**10]), (2, [-(2.0**16), 5.0])]
    assert got(spark, rows) == brute(rows, 20, 20)
    with pytest.raises(Exception, match="64 bits"):
        got(spark, [(0, [1e300]), (1, [1.0])])


def test_a_query_scores_few_pairs():
    """On clustered vectors, each pair whose bound can't reach the query's best is left out."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(50, 64))
    values = np.floor(64 * (centres[rng.integers(50, size=20_000)] + 0.3 * rng.normal(size=(20_000, 64)))).astype(np.int64)
    ids, seen = np.arange(20_000), {}
    best, asked = search._Best(np.full(100, -(1 << 62)), 20), search.Chunk(ids[:100], values[:100])
    for start in range(0, 20_000, search.CHUNK):
        rows = slice(start, start + search.CHUNK)
        search.scan(best, asked, search.Chunk(ids[rows], values[rows]), seen)
    assert seen["pairs"] == 100 * 20_000 and seen["exact"] <= 0.05 * seen["pairs"]
    scores = values[:100] @ values.T
    scores[np.arange(100), np.arange(100)] = -(1 << 62)
    query, found, score = best.found
    for q in range(100):
        order = np.lexsort((ids, -scores[q]))[:20]
        assert found[query == q].tolist() == order.tolist() and score[query == q].tolist() == scores[q][order].tolist()
