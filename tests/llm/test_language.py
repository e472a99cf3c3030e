"""Accuracy, the smoothed host priors against plain sums, and odd rows."""

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from txlab.llm import language
from txlab.llm.language import SMOOTHING, decide, document_evidence, fit, gather, languages, visible_text


def test_languages_of_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = languages(docs, pages).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    right = [truth[r.doc_id] == r.language for r in found if r.doc_id is not None]
    assert len(right) == len(truth) and sum(right) / len(right) > 0.97
    assert sum(r.accepted for r in found) / len(found) > 0.99


def test_text_alone(spark, sf_dir):
    """Learned from half of the rows, read without any declaration."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars > 100")
    model = fit(docs.filter("doc_id % 2 = 0"))
    rest = docs.filter("doc_id % 2 = 1")
    rows = rest.select("lang", language.text_evidence(F.col("text"), model, spark).alias("e")).collect()
    right = [model.languages[max(range(len(model.languages)), key=lambda k: r.e[k])] == r.lang for r in rows]
    assert sum(right) / len(right) > 0.95


def test_host_priors(spark):
    rows = [("a.x.org", 3.0, 0.0)] * 5 + [("b.x.org", 0.0, 9.0)] * 20 + [("c.y.org", 0.0, 9.0)] * 3 + [(None, 9.0, 0.0)] * 4
    frame = spark.createDataFrame(rows, "host string, p double, q double").select(
        "host", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.array("p", "q", F.lit(50.0)).alias("text_evidence"),
    )
    got = {r.host: [math.exp(x) for x in r.host_evidence] for r in gather(frame, 2)[0].collect()}

    def post(p, q):
        return math.exp(p) / (math.exp(p) + math.exp(q))

    counts, domains, whole = {}, {}, [0.0, 0.0]
    for host, p, q in rows:
        for k, x in enumerate((post(p, q), post(q, p))):
            whole[k] += x
            if host:
                counts.setdefault(host, [0.0, 0.0])[k] += x
                domains.setdefault(host[2:], [0.0, 0.0])[k] += x
    base = [(w + 1) / (sum(whole) + 2) for w in whole]
    assert got.keys() == counts.keys()
    for host, own in counts.items():
        up = domains[host[2:]]
        above = [(up[k] + SMOOTHING * base[k]) / (sum(up) + SMOOTHING) for k in (0, 1)]
        assert got[host] == pytest.approx([(own[k] + SMOOTHING * above[k]) / (sum(own) + SMOOTHING) for k in (0, 1)])


def test_fused_posterior_is_the_plain_one(spark):
    """Text, host, declaration and suffix together, against sums and products in plain Python."""
    rng, names = random.Random(8), ["de", "en", "fr"]
    size, rows = 3, []
    for k in range(400):
        spoken = rng.randrange(3)
        text = [-rng.expovariate(0.3) * (j != spoken) for j in range(3)]
        text = [t - max(text) for t in text]
        known = 0.0 if rng.random() < 0.1 else float(rng.randint(3, 90))
        host = rng.choice([None, f"h{spoken}.a.org", f"h{rng.randrange(6)}.b.net", "lone.c.io"])
        declared = rng.choice([None, names[spoken], rng.choice(names), "xx"])
        rows.append((k, host, declared, rng.choice([None, f"org/{spoken}", "net/"]), [*text, known, rng.uniform(-9, 4)]))
    frame = spark.createDataFrame(rows, "k long, host string, declared string, suffix string, text_evidence array<double>")
    model = SimpleNamespace(languages=names)
    got = {r.k: r for r in decide(frame, model, gather(frame, size)).collect()}

    def softmax(values):
        each = [math.exp(v - max(values)) for v in values]
        return [e / sum(each) for e in each]

    def domain(host):
        return ".".join(host.split(".")[-2:])

    sums, whole = {}, [0.0] * size
    for _, host, declared, suffix, text in rows:
        if text[size] <= 0 or text[size + 1] > 0:
            continue
        for j, p in enumerate(softmax(text[:size])):
            if p > 1e-12:
                whole[j] += p
                for key in [("host", host), ("declared", declared), ("suffix", suffix)] + ([("domain", domain(host))] if host else []):
                    sums.setdefault(key, [0.0] * size)[j] += p
    base = [(w + 1) / (sum(whole) + size) for w in whole]

    def prior(host, j):
        if host is None or ("host", host) not in sums:
            return 0.0
        own, up = sums["host", host], sums["domain", domain(host)]
        above = (up[j] + SMOOTHING * base[j]) / (sum(up) + SMOOTHING)
        return math.log((own[j] + SMOOTHING * above) / (sum(own) + SMOOTHING))

    def given(kind, value, j):
        if value is None or (kind, value) not in sums:
            return 0.0
        own = sums[kind, value]
        return math.log((own[j] + SMOOTHING * sum(own) / max(sum(whole), 1.0)) / (base[j] * sum(whole) + SMOOTHING))

    for k, host, declared, suffix, text in rows:
        post = softmax([text[j] + prior(host, j) + given("declared", declared, j) + given("suffix", suffix, j) for j in range(size)])
        confidence = max(post) / (1 + math.exp(text[size + 1]))
        assert got[k].confidence == pytest.approx(confidence, rel=1e-9)
        assert got[k].language == (names[post.index(max(post))] if text[size] > 0 else None)
        assert got[k].accepted == (text[size] > 0 and confidence >= language.ACCEPT)


def test_visible_text(spark):
    html = "<html><STYLE>a</style ><script x='1'>b</b></script>c<!-- d -->e<b f='g'>h</b>"
    assert spark.range(1).select(visible_text(F.lit(html)).alias("t")).first().t.split() == ["c", "e", "h"]


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, host int, _post string, text_evidence int"
    english, french = "the house and the garden of the king", "le roi et la reine dans le jardin"
    rows = [(i, english, "en", "s") for i in range(30)] + [(100 + i, french, "fr", "s") for i in range(30)]
    odd = [(1000, None, "en", "s"), (1001, "", None, None), (1002, "!?", "en", None), (None, english, None, None),
           (3, english, "xx", "new"), (3, english, "xx", "new"), (1003, french + " " + english * 20_000, "", "s")]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows + odd], schema)
    pages = "page_id long, url string, html string"
    some = [(1, None, None), (2, "x", ""), (3, "http://a.fr/fr/1", f"<html lang=fr><body>{french}</body>"), (None, "http:///", "<p>the king")]
    found = languages(docs, spark.createDataFrame(some, pages)).collect()
    assert len(found) == len(rows) + len(odd) + len(some)
    by = {(r.doc_id, r.page_id): r for r in found}
    for key in ((1000, None), (1001, None), (1002, None), (None, 1), (None, 2)):
        assert by[key].language is None and not by[key].accepted
    assert by[(3, None)].language == "en" and by[(1003, None)].language == "en" and by[(None, 3)].language == "fr"
    empty = languages(docs.limit(0), spark.createDataFrame(some, pages)).collect()
    assert [r.accepted for r in empty] == [False] * 4
    assert languages(docs.limit(0), spark.createDataFrame([], pages)).count() == 0


def _accepted(spark, docs, texts):
    """Learned from ``docs``; texts that declare English."""
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    more = [(10**6 + k, text, "en", rows[0].source) for k, text in enumerate(texts)]
    all_docs = spark.createDataFrame([tuple(r) for r in rows] + more, "doc_id long, text string, lang string, source string")
    model = fit(docs)
    evidence = document_evidence(all_docs, model)
    found = language.decide(evidence, model, gather(evidence, len(model.languages))).collect()
    return [r.accepted for r in sorted(found, key=lambda r: r.doc_id) if r.doc_id >= 10**6]


def test_texts_in_no_known_language_are_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("qwertyuiopasdfghjklzxcvbnm") for _ in range(rng.randint(2, 9))) for _ in range(40)) for _ in range(20)]
    texts += ["Съешь же ещё этих мягких французских булок, да выпей чаю", "我能吞下玻璃而不伤身体。我能吞下玻璃", "1234 5678 2abc3", "asdf jkl asdf qwer zxcv uiop fghj"]
    assert not any(_accepted(spark, docs, texts))
    for unknown in ("en", "fr"):
        texts = [r.text for r in docs.filter(f"lang = '{unknown}' AND n_chars > 200").limit(20).collect()]
        assert sum(_accepted(spark, docs.filter(f"lang <> '{unknown}'"), texts)) <= 1


def test_unseen_trigrams_favour_no_language(spark):
    rows = [(f"the king of garden {i}", "en") for i in range(500)] + [(f"le roi du jardin {i}", "fr") for i in range(5)]
    reader = language.Reader(fit(spark.createDataFrame(rows, "text string, lang string")))
    evidence = reader.read("съешь ещё".encode())
    assert evidence[0] == evidence[1] and evidence[-1] > 0


def test_every_language_is_learned_under_one_name(spark):
    rng = random.Random(4)
    rows = []
    for k in range(80):
        syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
        tag = f"{chr(97 + k // 26)}{chr(97 + k % 26)}"
        for i in range(12):
            text = " ".join("".join(rng.choice(syllables) for _ in range(2)) for _ in range(60))
            rows.append((100 * k + i, text, (tag, tag.upper(), f"{tag}-XX", f"{tag}_yy")[i % 4], tag))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, tag string").withColumn("source", F.lit("s"))
    model = fit(docs)
    assert model.languages == sorted({r[3] for r in rows})
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    truth = {r[0]: r[3] for r in rows}
    assert all(r.language == truth[r.doc_id] and r.accepted for r in languages(docs, pages).collect())


def test_copies_are_drawn_one_by_one(spark, monkeypatch):
    """A group of copies that is half of a language's rows is about half of its sample, and junk tags are no languages."""
    monkeypatch.setattr(language, "SAMPLE", 100)
    rows = [(i, "the same text for all of these" if i % 2 else f"text number {i} of its own", "en") for i in range(4000)]
    rows += [(10_000 + i, "junk", tag) for i in range(30) for tag in ("e1", "english", "??", "x" * 40, "")]
    drawn = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    copies = sum(r.text.startswith("the same") for r in drawn)
    assert {r.lang for r in drawn} == {"en"} and 60 <= len(drawn) <= 150 and 0.3 <= copies / len(drawn) <= 0.7
