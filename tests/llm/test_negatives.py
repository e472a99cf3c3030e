"""Hard negatives against all pairs, the threshold join against plain scores, and odd rows."""

import math
import random

import numpy as np
import pytest

from txlab.llm import negatives
from txlab.llm.negatives import Vectors, energy_order, hard_negatives, join


def brute(rows, every, n_positives, n_negatives):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, label, x in usable:
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in usable if i != a and len(x) == len(y)]
        scored.sort()
        positives = [(i, -s) for s, i, other in scored if other == label][:n_positives]
        for positive, score in positives:
            fits = [(i, -s) for s, i, other in scored if other != label and 30 * score <= -100 * s <= 90 * score]
            out += [(a, positive, k + 1, i, score, s) for k, (i, s) in enumerate(fits[:n_negatives])]
    return sorted(out)


def vectors(n, dim, labels, seed, spread=1.0, rounded=False):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        v = [float(np.float32(c + rng.gauss(0, 0.4))) for c in rng.choice(centres)]
        rows.append((i, rng.randrange(labels), [round(x) / 2 for x in v] if rounded else v))
    return rows


def got(spark, rows, **options):
    schema = "vec_id long, label int, embedding array<double>, at int, slot string, number int, score int, dim int, rank int"
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], schema)
    return sorted(tuple(r) for r in hard_negatives(frame, **options).collect())


@pytest.mark.parametrize(
    ("n", "dim", "labels", "every", "rounded"), [(600, 32, 4, 20, False), (400, 5, 2, 10, True), (300, 13, 60, 7, False), (250, 3, 1, 9, True)]
)
def test_all_pairs(spark, monkeypatch, n, dim, labels, every, rounded):
    for name, value in (("PART_BYTES", 2 * dim * 16), ("ASKED_BYTES", 2 * dim * 8), ("CHUNKS", (8, 32)), ("ANCHORS_AT_ONCE", 5)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(n, dim, labels, n, rounded=rounded)
    expected = brute(rows, every, 5, 10)
    assert got(spark, rows, every=every) == expected
    assert bool(expected) == (labels > 1)


def test_odd_rows(spark):
    rows = vectors(120, 4, 3, 9, rounded=True)
    rows += [(200, 1, None), (201, None, [1.0] * 4), (202, 1, [1.0, None, 0.0, 0.0]), (203, 1, [float("nan")] * 4)]
    rows += [(204, 1, [float("inf")] * 4), (None, 1, [1.0] * 4), (300, 1, []), (301, 1, []), (302, 2, []), (400, 0, [1.0, 2.0])]
    rows += [(500, 1, [2.0] * 4)] * 3 + [(501, 1, [1.0] * 4)] * 3 + [(502, 2, [0.5] * 4)] * 4 + [(600, 2, [-9.0] * 4)]
    assert got(spark, rows, every=20) == brute(rows, 20, 5, 10)
    assert got(spark, []) == []
    assert got(spark, [(100, 1, [1.0])]) == []


def test_large_numbers(spark):
    rows = [(0, 1, [2.0**19, 1.0]), (1, 1, [2.0**18, 2.0**10]), (2, 2, [2.0**17, 5.0]), (3, 2, [2.0**16, -1.0])]
    assert got(spark, rows, every=20) == brute(rows, 20, 5, 10)
    with pytest.raises(Exception, match="64 bits"):
        got(spark, [(0, 1, [1e300]), (1, 1, [1.0])])


@pytest.mark.parametrize("dim", [0, 1, 8, 40, 64])
def test_join_is_exact(dim):
    rng = np.random.default_rng(dim)
    x, y = (np.floor(256 * rng.normal(size=(n, dim))).astype(np.int64) for n in (30, 200))
    order = energy_order(y)
    scores = x @ y.T
    for share in (0.0, 0.5, 0.9, 0.999):
        least = np.quantile(scores, share, axis=1).astype(np.int64)
        rows, columns, found = join(Vectors(x, order), Vectors(y, order), least)
        assert sorted(zip(rows, columns, found)) == [(i, j, scores[i, j]) for i in range(30) for j in range(200) if scores[i, j] >= least[i]]


def test_join_prunes_pairs():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 64))
    y = np.floor(40 * (centres[rng.integers(40, size=4000)] + 0.3 * rng.normal(size=(4000, 64)))).astype(np.int64)
    order, scores, seen = energy_order(y), y[:50] @ y.T, {}
    least = np.sort(scores, axis=1)[:, -20]
    join(Vectors(y[:50], order), Vectors(y, order), least, seen)
    assert seen["pairs"] == 50 * 4000 and seen["exact"] <= 0.05 * seen["pairs"]


def test_a_later_chunk_is_searched_down_to_the_best_so_far():
    order, lengths = np.arange(1), np.asarray([100, 90, 80, 70, 60, 50, 5_000, 4_000, 75, 65])
    rows = {"vec_id": np.arange(1, 11), "label": np.full(10, 2), "values": lengths[:, None]}
    anchor = {"vec_id": np.asarray([0]), "label": np.asarray([1]), "values": np.asarray([[1]])}
    windows = negatives._Windows(np.asarray([0]), np.asarray([1]), np.asarray([6_000]), 7)
    for part in (slice(0, 6), slice(6, 10)):
        some = negatives._some(rows, part, order)
        negatives._search_chunk(windows, negatives._some(anchor, slice(0, 1), order), some, False)
    assert windows.found[2].tolist() == [5_000, 4_000, 100, 90, 80, 75, 70]


def test_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(3, 8))[rng.integers(3, size=1400)] + 0.3 * rng.normal(size=(1400, 8))
    values *= 10.0 ** rng.uniform(-3, 2, size=(1400, 1))
    rows = [(i, int(rng.integers(4)), [float(np.float32(x)) for x in v]) for i, v in enumerate(values)]
    assert got(spark, rows, every=20) == brute(rows, 20, 5, 10)
