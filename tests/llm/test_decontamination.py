"""Winnowing against every window, and odd rows."""

import random
import re

import pytest

from txlab.llm import decontamination
from txlab.llm.decontamination import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), 10)
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    sizes = {len(x) for x in windows}
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (key := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[key]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "ÉÀ", "ß9"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 7, 9, 10, 11, 15, 30])))) for i in range(25)]
    docs = []
    for i in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1].split()
            low = rng.randrange(len(source))
            at = rng.randint(0, len(w))
            w[at:at] = source[low : low + rng.randint(1, 20)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).upper() if i % 3 else " ".join(w)))
    return docs, items


def result(frame):
    return sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in frame.collect())


@pytest.mark.parametrize(("seed", "blocks"), [(1, 200_000), (2, 40), (3, 200_000)])
def test_every_window(spark, monkeypatch, seed, blocks):
    monkeypatch.setattr(decontamination, "BLOCK_ROWS", blocks)
    docs, items = case(seed)
    if seed == 3:
        items = [x for x in items if len(x[1].split()) >= 10]
    frame = decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert result(frame) == sorted(brute(docs, items))


def test_odd_rows(spark, table):
    passage = " ".join(f"p{i}" for i in range(10))
    long = " ".join(["q"] * 30_000) + " " + passage
    items = [(1, passage), (1, passage), (2, None), (3, ""), (4, "..."), (5, passage + " p10"), (None, "z y x")]
    docs = [(1, None), (2, ""), (3, "!!"), (4, f"..{passage}!"), (4, f"..{passage}!"), (5, long), (6, passage[:-1]), (7, "z Y x")]
    frame = decontaminate(table(docs), spark.createDataFrame(items, "item_id long, text string"))
    distinct = list(dict.fromkeys(docs))
    assert result(frame) == sorted(brute(distinct, items), key=lambda r: r[0])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate(table(docs[3:5]), none).collect()] == [0]
    assert decontaminate(table([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate(table([(None, passage)]), spark.createDataFrame(items, "item_id long, text string")).first().n_hit == 10


@pytest.mark.parametrize("most", [1 << 26, 2_000_000])
def test_very_long_words(spark, table, monkeypatch, most):
    """Words of any length are compared; where they are long, what is broadcast at once has fewer."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", most)
    long = ["x" * 50_000 + str(k) for k in range(14)]
    docs = [(1, " ".join(["a", *long, "b"])), (2, " ".join(long[:9])), (3, " ".join(long[2:12])), (4, f"{long[3]}y {long[4]}")]
    items = spark.createDataFrame([("i", " ".join(long)), ("s", f"{long[3]} {long[4]}")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in decontaminate(table(docs), items).collect()}
    assert got == {1: (16, 14, ["i", "s"]), 2: (9, 2, ["s"]), 3: (10, 10, ["i", "s"]), 4: (2, 0, [])}
