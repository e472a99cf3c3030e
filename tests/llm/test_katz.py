"""Katz scores against a plain model, exact normalisation, and odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.llm import katz
from txlab.llm.katz import DISCOUNTED, Totals, differences, discounts, from_differences, from_planes, katz_scores, planes

BEGIN, END = " ", "\n"


def tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [BEGIN, *re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class Plain:
    """The same model by dictionaries and recursion."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [None] + [Counter() for _ in range(order)]
        for words in map(tokens, texts):
            for n in range(1, order + 1):
                self.counts[n].update(tuple(words[i - n + 1 : i + 1]) for i in range(n - 1, len(words)))
        self.single = Counter({k: c for k, c in self.counts[1].items() if k != (BEGIN,)})
        self.total = sum(self.single.values())
        self.rates = [None]
        for n in range(1, order + 1):
            held = self.single if n == 1 else self.counts[n]
            self.rates.append(discounts([sum(c == r for c in held.values()) for r in range(1, DISCOUNTED + 2)]))
        self.after = [None] + [defaultdict(list) for _ in range(order)]
        for n in range(2, order + 1):
            for gram in self.counts[n]:
                self.after[n][gram[:-1]].append(gram[-1])
        self.kept = {}

    def rate(self, n, c):
        return self.rates[n][min(c, DISCOUNTED + 1)]

    def lowest(self, word):
        if not self.total:
            return 1.0
        c = self.single.get((word,), 0)
        freed = sum((1 - self.rate(1, k)) * k for k in self.single.values())
        if not freed:
            return max(c, 1) / (self.total + 1)
        return self.rate(1, c) * c / self.total if c else freed / self.total

    def context(self, h):
        """What is counted around a context, and its backoff weight."""
        if h not in self.kept:
            n, around = len(h) + 1, self.counts[len(h)][h]
            grams = [(w, self.counts[n][(*h, w)]) for w in self.after[n][h]]
            freed = sum((1 - self.rate(n, c)) * c for _, c in grams)
            around, freed = (around, freed) if freed else (around + 1, 1.0)
            low = sum(self.p(w, h[1:]) for w, _ in grams)
            self.kept[h] = around, freed / around / (1 - low)
        return self.kept[h]

    def p(self, word, h):
        if not h:
            return self.lowest(word)
        if not self.counts[len(h)][h]:
            return self.p(word, h[1:])
        around, weight = self.context(h)
        c = self.counts[len(h) + 1][(*h, word)]
        return self.rate(len(h) + 1, c) * c / around if c else weight * self.p(word, h[1:])

    def row(self, text):
        words = tokens(text)
        n = [self.single.get((w,), 0) for w in words[1:]]
        base = sum(math.log10((c + 0.5) / (self.total + 0.5 * (len(self.single) + 1))) for c in n)
        score = sum(
            math.log10(self.p(words[i], tuple(words[max(0, i - self.order + 1) : i]))) for i in range(1, len(words))
        )
        return len(n), sum(c > 0 for c in n), self.total, base, score


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    made = []
    for _ in range(n):
        words = [vocabulary[min(int(rng.expovariate(0.15)), 59)] for _ in range(rng.randint(0, 40))]
        made.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
    return made


def same(frame, expected):
    found = sorted((tuple(r) for r in frame.collect()), key=str)
    expected = sorted(expected, key=str)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize(("order", "block_tokens"), [(2, 2_500_000), (2, 60), (3, 100), (4, 150)])
def test_plain_model(spark, table, monkeypatch, order, block_tokens):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(katz, "LEAST_PARTS", 5)
    rows = list(enumerate(texts(order)))
    model = Plain([t for k, t in rows if k % 4], order)
    frame = katz_scores(table(rows), F.col("doc_id") % 4 != 0, order)
    same(frame, [(k, k % 4 == 0, *model.row(t)) for k, t in rows])


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up(spark, order):
    """Over every known word, the end and one unknown word, after seen and unseen contexts."""
    learned = texts(9, 40)
    known = sorted({w for t in learned for w in tokens(t)[1:-1]})
    contexts = ["", "w0", "w3 w1", "w1 w0 w2", "never", "w0 never", known[-1]]
    rows = [(k, t) for k, t in enumerate(learned)]
    asked = [(1000 * (c + 1) + k, f"{context} {w}") for c, context in enumerate(contexts) for k, w in enumerate([*known, "unknown"])]
    asked += [(-c - 1, context) for c, context in enumerate(contexts)]
    frame = katz_scores(spark.createDataFrame(rows + asked, "doc_id long, text string"), F.col("doc_id").between(0, 999), order)
    model = Plain(learned, order)
    score = {r.doc_id: r.score for r in frame.collect()}
    for c, context in enumerate(contexts):
        before = tokens(context)[:-1]
        start = sum(math.log10(model.p(before[i], tuple(before[max(0, i - order + 1) : i]))) for i in range(1, len(before)))
        total = 10 ** (score[-c - 1] - start)  # the end
        for k, w in enumerate([*known, "unknown"]):
            words = [*before, w]
            end = math.log10(model.p(END, tuple(words[max(0, len(words) - order + 1) :])))
            total += 10 ** (score[1000 * (c + 1) + k] - start - end)
        assert total == pytest.approx(1, abs=1e-9)


def test_odd_rows(spark, table):
    rows = [(1, None), (2, ""), (3, "a\tb\nc\x0bd\x0c\re   x É é"), (4, "a a a " * 9), (4, "a a a " * 9), (None, "A b c"), (None, None)]
    rows += [(5, "long" * 50_000), (6, "many words " * 20_000), (7, "new words only"), (8, "\x00 \x00 7")]
    learn = F.coalesce(F.col("doc_id") < 7, F.lit(True))
    model = Plain([t for k, t in rows if k is None or k < 7], 2)
    same(katz_scores(table(rows), learn), [(k, k is not None and k >= 7, *model.row(t)) for k, t in rows])
    assert katz_scores(table([]), learn).collect() == []


def test_nothing_to_learn(spark, table):
    rows = [(1, "a b"), (2, None)]
    same(katz_scores(table(rows), F.lit(False)), [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)])
    same(katz_scores(table(rows), F.lit(None).cast("boolean")), [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)])


def test_discounts():
    n = [1000, 400, 220, 140, 100, 75]
    rate = discounts(n)
    assert rate[0] == rate[-1] == 1 and (np.diff(rate[1:]) > 0).all()
    r = np.arange(1, DISCOUNTED + 1)
    # The discounts free as much as Good-Turing gives to unseen tokens.
    assert ((1 - rate[1:-1]) * r * n[:-1]).sum() == pytest.approx(n[0])
    assert discounts([0] * 6)[1] == 0.5
    assert Totals.of({}, 2).tokens == 0


def test_packing():
    rng = np.random.default_rng(1)
    for most in (1, 255, 256, 70_000, 1 << 40, (1 << 64) - 1):
        keys = np.unique(rng.integers(0, most, 50, np.uint64, endpoint=True))
        assert (from_differences(differences(keys)) == keys).all()
        assert (from_planes(planes(keys)) == keys).all()
    floats = rng.normal(size=9)
    assert (from_planes(planes(floats), "f") == floats).all()
