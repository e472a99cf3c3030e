"""Given and mined rules against plain Python, and odd rows."""

import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from txlab.llm import urls
from txlab.llm.urls import RULES, judge, labelled_tokens, match, mine, tokens_of

LABELS = "doc_id long, quality int, toxic int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_given_rules(spark):
    odd = [None, "", "a.net/x", "http://a.net", "http://a.net/", "http://net/x", "http://NET/x", "http://knet/x", "http://ÄB.NeT/x",
           "https://b.example.net/en/1?q", "http://example.net/en", "http://example.com/de/", "http://x.example.com/DE/",
           "http://x.org/fr/1#a", "http://a?b/c", "http://a#b/", "://net/", "x://y://net/", "http:///fr/", "http://a.net\n/en/"]
    frame = spark.createDataFrame([(i, u, 1) for i, u in enumerate(odd)], "page_id long, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(frame, spark.createDataFrame([], LABELS)).collect()}
    for i, u in enumerate(odd):
        host, path = parts(u)
        name, verdict = rule(host, path)
        assert got[i] == (host, path, name, verdict or "allow"), u


def pages(spark):
    rows, labels = [], []
    for i in range(600):
        spam = i % 3 == 0
        host = "casino-win.example" if spam and i % 2 == 0 else f"h{i % 7}.example"
        rows.append((i, f"https://{host}/xx/{i}" + ("?utm=1" if i % 5 else "")))
        labels.append((i, 0 if spam and i % 2 == 0 and i % 24 else 1, 1 if i % 50 == 1 else 0))
    return spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, LABELS)


def test_mined_rules_are_the_frequent_sets(spark):
    frame, labels = pages(spark)
    labelled = labelled_tokens(frame, labels)
    sets = [set(r["items"]) for r in labelled.collect()]
    assert len(sets) == 600
    bad = sum("label=bad" in s for s in sets) / len(sets)
    plain = {tuple(sorted(t for t in s if not t.startswith("label="))) for s in sets}
    expected = {}
    for size in range(1, 1 + max(map(len, plain))):
        for some in {c for names in plain for c in combinations(names, size)}:
            held = [s for s in sets if s.issuperset(some)]
            both = sum("label=bad" in s for s in held)
            if both >= 0.05 * len(sets) and both / len(held) >= 0.6 and both / len(held) / bad >= urls.LEAST_LIFT:
                expected[some] = round(both / len(held), 9)
    got = {tuple(sorted(r.tokens)): round(r.confidence, 9) for r in mine(labelled, support=0.05).collect()}
    assert got == expected and got


def test_matching_finds_the_best_rule(spark):
    frame, labels = pages(spark)
    rules = mine(labelled_tokens(frame, labels), support=0.05)
    held = [(r.confidence, r.support, sorted(r.tokens)) for r in rules.collect()]
    addresses = frame.select(F.col("page_id").alias("key"), tokens_of(F.col("url")).alias("tokens"))
    got = {r.key: (r.confidence, r.rule_tokens) for r in match(addresses, rules).collect()}
    for row in addresses.collect():
        fits = [(c, s, t) for c, s, t in held if set(t) <= set(row.tokens)]
        best = max(fits, default=None)
        assert got.get(row.key) == (best and (best[0], best[2]))


def test_whole_and_odd_rows(spark):
    frame, labels = pages(spark)
    odd = [(1, "https://casino-win.example/xx/1"), (1, "https://casino-win.example/xx/1"), (None, None)]
    odd = spark.createDataFrame(odd, "page_id long, url string")
    rows = judge(frame.union(odd).union(odd), labels).collect()
    assert len(rows) == 606
    assert {r.verdict for r in rows if r.host == "casino-win.example"} == {"block"}
    assert {r.verdict for r in rows if r.host != "casino-win.example"} == {"allow"}
    long = spark.createDataFrame([(1, "http://a.b/" + "x/" * 50_000)], "page_id long, url string")
    assert judge(long, labels).first().verdict == "allow"
    assert judge(frame.limit(0), labels).count() == 0
    nothing = spark.createDataFrame([(None, None, None), (1, None, None)], LABELS)
    assert {r.verdict for r in judge(frame, nothing).collect()} == {"allow"}


def test_a_small_certain_host_is_a_rule_among_many_pages(spark):
    rows = [(i, f"https://h{i % 7}.example/xx/{i}") for i in range(12_000)]
    rows += [(20_000 + i, f"https://rare-trap.example/xx/{20_000 + i}") for i in range(40)]
    labels = spark.createDataFrame([(i, 0 if i >= 20_000 or i % 20 == 0 else 1, 0) for i, _ in rows], LABELS)
    found = judge(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(20_000, 20_040))


def test_chance_makes_no_rule(spark):
    """Labels that don't depend on addresses: no page is blocked, however many hosts there are to find a rule by chance."""
    rng = random.Random(5)
    for hosts in (3, 30, 120):
        rows = [(i, f"https://h{i % hosts}.example/{rng.choice('abc')}/{i}?{rng.choice('xyz')}=1") for i in range(hosts * 100)]
        labels = spark.createDataFrame([(i, int(rng.random() < 0.75), 0) for i, _ in rows], LABELS)
        frame = spark.createDataFrame(rows, "page_id long, url string")
        assert mine(labelled_tokens(frame, labels)).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_no_rule_from_the_given_tables(spark, sf):
    pages, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("pages", "labels"))
    assert {(r.rule is None, r.verdict) for r in judge(pages, labels).collect() if r.rule is None} == {(True, "allow")}


def test_rules_do_not_grow_with_the_pages(spark):
    """The same web, more of its pages: the rules are those of its bad hosts and paths."""
    counts = []
    for times in (1, 4):
        rows = [(i, f"https://h{i % 20}.example/{'bad' if i % 10 == 3 else 'good'}/{i % 4}/{i}") for i in range(2000 * times)]
        labels = spark.createDataFrame([(i, int(i % 10 != 3), 0) for i, _ in rows], LABELS)
        counts.append(mine(labelled_tokens(spark.createDataFrame(rows, "page_id long, url string"), labels)).count())
    assert 0 < counts[1] <= counts[0]
