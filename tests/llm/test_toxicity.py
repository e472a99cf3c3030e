"""Exact neighbours, held-out accuracy, and odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txlab.llm import toxicity as tox
from txlab.llm.common import words
from txlab.llm.toxicity import Scorer, fit, held_out, toxicity

SCHEMA = "doc_id long, toxic int"


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    clean = [f"w{i}" for i in range(300)]
    bad = [f"insult{i}" for i in range(8)] + [f"vileword{i}{c}" for i in range(2) for c in "abcdef"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(clean) for _ in range(rng.randint(3, 60))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 6)):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return rows, labels


def plain_cosines(model, texts, examples, n_docs, frequency):
    """Cosines of every text with every example over all words, by dictionaries."""

    def vector(text):
        counts = Counter(words(text.encode()))
        weight = {}
        for word, n in counts.items():
            number = model.hashes.searchsorted(np.uint64(xxhash.xxh3_64_intdigest(word)))
            if number < len(model.hashes) and model.hashes[number] == xxhash.xxh3_64_intdigest(word):
                weight[word] = (1 + math.log(n)) * model.weights[number]
                strength = model.weights[number] / (math.log((n_docs + 1) / (frequency[word] + 1)) + 1)
                assert tox.LEAST_STRENGTH - 1e-9 <= strength <= 1 + 1e-9
        length = math.sqrt(sum(x * x for x in weight.values()))
        return {w: x / length for w, x in weight.items()}

    held = {doc_id: vector(text) for doc_id, text in examples}
    out = []
    for text in texts:
        own = vector(text)
        out.append({d: sum(x * v[w] for w, x in own.items() if w in v) for d, v in held.items()})
    return out


@pytest.mark.parametrize(("block", "first", "share"), [(64, 4, 1 / 32), (4, 1, 0.2), (8, 2, 2.0)])
def test_neighbours_are_those_of_full_vectors(spark, monkeypatch, block, first, share):
    for name, value in (("BLOCK", block), ("FIRST_BLOCKS", first), ("COMMON_SHARE", share)):
        monkeypatch.setattr(tox, name, value)
    rows, labels = corpus(300)
    model = fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, SCHEMA), F.lit(True))
    frequency = Counter(w for _, text in rows for w in set(words(text.encode())))
    texts = [text for _, text in rows] + ["w1", "insult0 w2 w2 unknown", "only unknown words"]
    chosen = set(model.ids.tolist())
    plain = plain_cosines(model, texts, [r for r in rows if r[0] in chosen], len(rows), frequency)
    scorer = Scorer(model)
    places, cosines = scorer.nearest([t.encode() for t in texts])
    for found, at, expected in zip(cosines, places, plain):
        best = sorted(expected.values(), reverse=True)[: tox.NEIGHBOURS]
        assert np.allclose(found, best, atol=1e-5)
        near = at[found > 0]
        assert np.allclose([expected[model.ids[k]] for k in near], found[found > 0], atol=1e-5)
        assert len(near) == min(tox.NEIGHBOURS, sum(x > 0 for x in expected.values()))
    assert scorer.opened <= scorer.met


def test_bounds_spare_blocks(spark):
    """Texts of other subjects lie in blocks that are never opened."""
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        subject = i % 12
        text = [f"s{subject}x{rng.randrange(30)}" for _ in range(30)] + ["the", "of"]
        rows.append((i, " ".join(text + ["insult"] * (i % 5 == 0))))
    labels = [(i, int(i % 5 == 0)) for i, _ in rows]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, SCHEMA), F.lit(True))
    scorer = Scorer(model)
    scorer.nearest([text.encode() for _, text in rows])
    assert scorer.opened < 0.6 * scorer.met


def test_every_text_that_shares_a_word_has_neighbours(spark, table):
    rows, labels = corpus(400)
    more = [(9000, "w7"), (9001, "unheard"), (9002, "unheard w9 of")]
    found = {r.doc_id: r for r in toxicity(table(rows + more), spark.createDataFrame(labels, SCHEMA)).collect()}
    assert found[9000].neighbours and found[9002].neighbours and not found[9001].neighbours
    assert all(len(r.neighbours) == tox.NEIGHBOURS for d, r in found.items() if d < 9000)


def test_copies_give_one_example(spark):
    rows = [(i, "first text of copies") for i in range(30, 0, -1)] + [(i, f"other w{i}") for i in range(100, 140)]
    labels = [(i, int(i < 100)) for i, _ in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = fit(frame, spark.createDataFrame(labels, SCHEMA), F.lit(True))
    assert [i for i in model.ids if i < 100] == [1]


def test_held_out_accuracy(spark, table):
    rows, labels = corpus(1500)
    truth = dict(labels)
    found = toxicity(table(rows), spark.createDataFrame(labels, SCHEMA)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_are_not_read(spark, table):
    rows, labels = corpus(400)
    turned = [(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels]
    one, two = (
        sorted((r.doc_id, r.score) for r in toxicity(table(rows), spark.createDataFrame(x, SCHEMA)).collect()) for x in (labels, turned)
    )
    assert one == two


def test_odd_rows(spark, table):
    rows, labels = corpus(300)
    odd = [(1000, None), (1001, ""), (1002, " !"), (None, "insult1"), (5, rows[5][1]), (1003, "w1 " * 50_000 + "insult1 insult2")]
    marks = [*labels, (None, 1), (7, None), (1000, 0), (1001, 1), (5, 1), (5, 1), (4000, 1)]
    found = toxicity(table(rows + odd), spark.createDataFrame(marks, SCHEMA)).collect()
    assert len(found) == len(rows) + len(odd)
    scores = {r.doc_id: r.score for r in found}
    assert scores[1000] == scores[1001] == scores[1002] < 0.5
    assert not next(r for r in found if r.doc_id is None).held_out
    for none in ([], [(1, 0), (2, 0)], [(1, 1)]):
        one = {r.score for r in toxicity(table(rows), spark.createDataFrame(none, SCHEMA)).collect()}
        assert len(one) == 1
    assert toxicity(table([]), spark.createDataFrame(labels, SCHEMA)).count() == 0
    assert spark.range(1).select(held_out(F.lit(None).cast("long")).alias("x")).first().x is False
