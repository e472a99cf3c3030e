"""Spelling variants against all pairs of words, tiles against edit distance, and odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from txlab.llm import spelling
from txlab.llm.spelling import near_words, spelling_variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            mark = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if mark % 31 == 0:
                cut = mark % len(run)
                run = run[:cut] + run[cut + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    form, near = {}, {}
    for a, n in counts.items():
        around = [b for b in counts if one_edit(a, b)]
        near[a] = len(around)
        best = min(around, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, near[word], counts.get(form[word])))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def corpus(seed, letters, lengths, words, docs):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(words)]
    rows = []
    for k in range(docs):
        text = []
        for _ in range(rng.randint(20, 120)):
            word = vocabulary[min(int(rng.expovariate(0.08)), words - 1)]
            if rng.random() < 0.1:
                cut = rng.randrange(len(word))
                word = word[:cut] + rng.choice(["", rng.choice(letters), word[cut] * 2]) + word[cut + 1 :]
            text.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize(("letters", "group_rows", "tile"), [("abé×", 2048, 128), ("ab", 8, 4), ("abcdefgh", 3, 16)])
def test_all_pairs(spark, table, monkeypatch, letters, group_rows, tile):
    monkeypatch.setattr(spelling, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(spelling, "TILE", tile)
    rows = corpus(len(letters), letters, (6, 11), 120, 90)
    expected = brute(rows)
    assert any(r[1] for r in expected)
    assert got(spelling_variants(table(rows))) == expected


def test_edits_at_every_place(spark, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP_ROWS", 4)
    base = "aabbbccdde"
    words = {base, "x"}
    for k in range(len(base) + 1):
        words |= {base[:k] + c + base[k:] for c in "abz"} | {base[:k] + base[k + 1 :], base[:k] + "z" + base[k + 1 :]}
    words = sorted(words)
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = sorted((r.word, r.near) for r in near_words(frame).collect())
    assert found == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_chains_of_forms(spark, table):
    counts = {"aaaaaaaa": 20_000, "aaaaaaab": 2_000, "aaaaaabb": 200, "aaaaabbb": 20, "aaaabbbb": 2, "caaabbbb": 2}
    rows = [(None, f"{word} " * n) for word, n in counts.items()]
    expected = brute(rows)
    assert {r[0]: r[2] for r in expected}["aaaabbbb"] == "aaaaaaaa"
    assert got(spelling_variants(table(rows))) == expected


def test_odd_rows(spark, table):
    long = "q" * 30_000
    rows = [(1, None), (2, ""), (3, "12 34 -- 中文文字字字字字"), (None, "nothing nothinh nothing")]
    rows += [(4, f"{long} {long}r"), (4, f"{long} {long}r"), (5, "Straßenbahn " * 25), (6, "Strassenbahn strasenbahn " * 3)]
    rows += [(7, "Étoilesé étoilesé " * 5), (8, "sh×rt1sh short " * 3), (None, "nothinh")]
    assert got(spelling_variants(table(rows))) == brute(rows)
    assert got(spelling_variants(table([]))) == []
    assert got(spelling_variants(table([(1, "all short")]))) == []


def test_result_types(spark, table):
    frame = spelling_variants(table([(1, "letters letters")]))
    assert frame.dtypes == [(c, "string") for c in ("word", "form", "root")] + [(c, "bigint") for c in ("n", "n_near", "form_n")]
