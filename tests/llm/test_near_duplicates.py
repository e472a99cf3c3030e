"""Near duplicates against all pairs, SuperMinHash against its definition, and odd rows."""

import random

import numpy as np
import pytest

from txlab.llm import near_duplicates as nd
from txlab.llm.common import WordHashes
from txlab.llm.components import components


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def families(seed, groups=5, size=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 90))]
        family = [base]
        for _ in range(size):
            source = rng.choice(family) if rng.random() < 0.4 else base
            rate = rng.choice([0.0, 0.01, 0.03, 0.06, 0.1])
            family.append([rng.choice(vocabulary) if rng.random() < rate else w for w in source])
        docs += [" ".join(words) for words in family]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("size", "direct"), [(2, 1), (2, 12), (5, 1)])
def test_all_pairs(spark, monkeypatch, size, direct):
    monkeypatch.setattr(nd, "DIRECT_ROWS", direct)
    docs = families(size * 10 + direct)
    sets = [{tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} for w in map(str.split, docs)]
    links = []
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    expected = roots(len(docs), links)
    assert len(set(expected)) < len(docs) - 30
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(frame, size=size).collect()}
    assert got == {i: (len(sets[i]), expected[i], i == expected[i]) for i in range(len(docs))}


def test_odd_rows(table):
    long = " ".join(f"v{i % 5000}x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (6, "a b c"), (6, "a b c"), (7, "A b\nc")]
    rows += [(8, long), (9, long + " end"), (None, "a b c"), (10, "x y z"), (10, "a b c"), (11, "x y z")]
    found = nd.near_duplicates(table(rows), size=2).collect()
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept, r.n_rows) for r in found), key=str)
    expected = [
        (0, 2, None, True, 1),
        (1, 0, 1, True, 1), (2, 0, 2, True, 1), (3, 0, 3, True, 1),
        (4, 1, 4, True, 1), (5, 1, 4, False, 1),
        (6, 2, 6, True, 2), (7, 2, 6, False, 1),
        (8, 59_999, 8, True, 1), (9, 60_000, 8, False, 1),
        (10, 2, 6, False, 1), (10, 2, 6, False, 1), (11, 2, 6, False, 1),
    ]
    assert got == sorted(expected, key=str)
    assert nd.near_duplicates(table([])).count() == 0


def test_signature_is_the_least_rank_of_each_place():
    elements = nd.shingle_hashes([b"%d" % i for i in range(7)], 1, WordHashes())
    places, ranks = 16, np.full(16, np.inf)
    for e in elements:
        order = list(range(places))
        with np.errstate(over="ignore"):
            for level in range(places):
                draw = nd.mix(np.array([e + np.uint64(level + 1) * nd._STEP]))
                pick = level + int(nd.mix(draw)[0] % np.uint64(places - level))
                order[level], order[pick] = order[pick], order[level]
                rank = level + float(draw[0] >> np.uint64(11)) * 2.0**-53
                ranks[order[level]] = min(ranks[order[level]], rank)
    assert np.array_equal(nd.superminhash(elements, places), ranks)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    a, b = pool[:700], pool[200:]
    same = np.mean(nd.superminhash(a, 512) == nd.superminhash(b, 512))
    assert abs(same - len(np.intersect1d(a, b)) / len(pool)) < 0.1


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (300, 299)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    expected = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 200)} | {300: 100}
    assert got == expected
    assert components(frame.filter("a = b")).count() == 0
