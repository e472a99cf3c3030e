"""Language of documents and pages by fusing several pieces of evidence.

Text: byte trigrams of the lower-cased words, with likelihoods learned from a
bounded sample of rows with a known language. Declared language, address suffix
and host: how often each value goes with each language, gathered by grouped
aggregation over all rows from the texts' own posteriors. A text far less likely
than is usual in its best language is in none of them. A host's counts are
smoothed with those of its domain, and these with those of all rows, so a rare
host leans on its domain. The logarithms add up to the posterior.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab.llm.common import held_in_worker, texts_as_bytes, words
from txlab.sources.staging import stage

#: The sample's rows for each language, about, and the rows that a language has at least.
SAMPLE = 2_000
LEAST_ROWS = 5
#: Trigrams of a text overlap; more than so many don't add to its weight.
WEIGHT = 60.0
SMOOTHING = 20.0
ACCEPT = 0.5
#: An unknown language is taken to have so many trigrams, equally often. A
#: language gives this share of its trigrams to those it hasn't been seen with.
UNKNOWN = 1 << 16
UNSEEN = 0.1
#: How far below what is usual in a language, in nats a trigram, its texts may lie.
MARGIN = 2.8
_DIGIT = re.compile(rb"[0-9]")


def grams(text: bytes) -> np.ndarray:
    """Numbers of the byte trigrams of a text's words, set between single spaces.

    Words with digits, as numbers, keys and addresses have, tell no language.
    """
    found = words(text)
    if _DIGIT.search(text):
        found = [w for w in found if not _DIGIT.search(w)]
    if not found:
        return np.empty(0, np.int64)
    raw = np.frombuffer(b" " + b" ".join(found) + b" ", np.uint8).astype(np.int32)
    return (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]


@dataclass
class Model:
    languages: list[str]
    #: Sorted trigrams of the sample; those of gram g have ``starts[g]`` to ``starts[g + 1]`` below.
    grams: np.ndarray
    starts: np.ndarray
    #: A language that has the gram, and by how much its log likelihood exceeds an unseen gram's.
    place: np.ndarray
    gain: np.ndarray
    #: Mean log likelihood of a trigram below which a text isn't taken to be in the language.
    least: np.ndarray


def main_language(lang: Column) -> Column:
    """A language tag's first part in small letters, or null if it isn't two or three letters.

    The form bounds the languages there can be, whatever else tags hold.
    """
    main = F.lower(F.substring_index(F.translate(F.trim(lang.cast("string")), "_", "-"), "-", 1))
    return F.when(main.rlike("^[a-z]{2,3}$"), main)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, Counter] = {}
    for batch in batches:
        keys = zip(batch.column("lang").to_pylist(), batch.column("half").to_pylist())
        for text, key in zip(texts_as_bytes(batch.column("text")), keys):
            values, n = np.unique(grams(text), return_counts=True)
            held.setdefault(key, Counter()).update(dict(zip(values.tolist(), n.tolist())))
    for (lang, half), counts in held.items():
        columns = [
            pa.array([lang] * len(counts), pa.string()),
            pa.array([half] * len(counts), pa.int32()),
            pa.array(list(counts), pa.int32()),
            pa.array(list(counts.values()), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "half", "gram", "n"])


def sample(rows: DataFrame) -> DataFrame:
    """``lang, half, text`` of about SAMPLE texts of each language that has LEAST_ROWS rows.

    Rows are drawn by text and, where there is one, ``doc_id``, so copies are
    drawn one by one. The half is 0 or 1, by the text alone.
    """
    doc_id = F.col("doc_id") if "doc_id" in rows.columns else F.lit(None)
    known = rows.select(
        F.col("text").cast("string").alias("text"),
        main_language(F.col("lang")).alias("lang"),
        doc_id.cast("string").alias("doc_id"),
    )
    known = known.filter("lang IS NOT NULL")
    sizes = known.groupBy("lang").count().filter(F.col("count") >= LEAST_ROWS).withColumnRenamed("count", "_n")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    half = F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int").alias("half")
    return known.join(F.broadcast(sizes), "lang").filter(draw < SAMPLE / F.col("_n")).select("lang", half, "text")


def _likelihood(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.log((1 - UNSEEN) * n / np.maximum(total, 1) + UNSEEN / UNKNOWN)


def fit(rows: DataFrame) -> Model:
    """Learn from ``text, lang``: about SAMPLE rows of each language with LEAST_ROWS rows.

    Rows without language are not learned from. The result grows with the
    sample's trigrams only; with no rows to learn from it knows no language. An
    unseen trigram is equally likely in every language, however small its
    sample. What is usual in a language is measured on either half of its sample
    with the likelihoods of the other one.
    """
    counted = sample(rows).mapInArrow(_gram_counts, "lang string, half int, gram int, n long")
    each = [F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)]
    table = counted.groupBy("lang", "gram").agg(*each).toArrow().combine_chunks()
    found = table.column("lang").to_numpy(zero_copy_only=False).astype(str)
    languages, place = np.unique(found, return_inverse=True)
    known, row = np.unique(table.column("gram").to_numpy(), return_inverse=True)
    halves = [table.column(f"n{h}").to_numpy().astype(np.float64) for h in (0, 1)]
    both = halves[0] + halves[1]
    size = len(languages)
    sums = [np.bincount(place, n, size) for n in (*halves, both)]
    crossed = sum(np.bincount(place, halves[1 - h] * _likelihood(halves[h], sums[h][place]), size) for h in (0, 1))
    usual = np.where((sums[0] > 0) & (sums[1] > 0), crossed / np.maximum(sums[2], 1), -np.inf)
    order = np.lexsort((place, row))
    gain = _likelihood(both, sums[2][place]) - np.log(UNSEEN / UNKNOWN)
    return Model(
        languages.tolist(),
        known.astype(np.int64),
        np.append(0, np.cumsum(np.bincount(row, minlength=len(known)))).astype(np.int64),
        place[order].astype(np.int32),
        gain[order].astype(np.float32),
        np.maximum(usual - MARGIN, -np.log(UNKNOWN)),
    )


class Reader:
    """Log likelihoods of texts, and how many trigrams they rest on."""

    def __init__(self, model: Model):
        self.model = model
        self.place = np.full(1 << 24, len(model.grams), np.int32 if len(model.grams) >= 1 << 16 else np.uint16)
        self.place[model.grams] = np.arange(len(model.grams))

    def read(self, text: bytes) -> np.ndarray:
        model, found = self.model, grams(text)
        size = len(model.languages)
        if not len(found) or not size:
            return np.zeros(size + 2)
        places = self.place[found]
        places, n = np.unique(places[places < len(model.grams)], return_counts=True)
        first = model.starts[places]
        held = model.starts[places + np.int64(1)] - first
        at = np.repeat(first - np.cumsum(held) + held, held) + np.arange(held.sum())
        total = np.bincount(model.place[at], model.gain[at] * np.repeat(n, held), size)
        mean = total / len(found) + np.log(UNSEEN / UNKNOWN)
        best, weight = mean.argmax(), min(WEIGHT, len(found))
        unknown = (model.least[best] - mean[best]) * weight
        return np.concatenate(((mean - mean[best]) * weight, (len(found), unknown)))


def text_evidence(text: Column, model: Model, spark) -> Column:
    """An array: the text's log likelihood in each language (best: 0), its number of trigrams, and
    the log likelihood of a language that isn't known."""
    shared = spark.sparkContext.broadcast(model)  # a number or two for each trigram of the sample
    number = uuid.uuid4().hex

    @F.arrow_udf("array<double>")
    def read(texts: pa.Array) -> pa.Array:
        reader = held_in_worker(("language", number), lambda: Reader(shared.value))
        out = [reader.read(t) for t in texts_as_bytes(texts)]
        width = len(reader.model.languages) + 2
        flat = np.concatenate(out) if out else np.empty(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * width, pa.int32()), pa.array(flat))

    return read(text)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _each(size: int, body) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), body)


def _posterior(scores: Column) -> Column:
    powers = _let(scores, lambda s: _let(F.array_max(s), lambda best: F.transform(s, lambda x: F.exp(x - best))))
    total = lambda p: F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return _let(powers, lambda p: _let(total(p), lambda t: F.transform(p, lambda x: x / t)))


def _unknown(size: int) -> Column:
    """How much likelier an unknown language is than the best one, as a logarithm."""
    return F.coalesce(F.get("text_evidence", F.lit(size + 1)), F.lit(float("-inf")))


def _held(sums: DataFrame, key: str) -> DataFrame:
    """``sums`` has ``key, k, s``; the result a row for each key: ``held`` gives s by k, ``total`` its sum."""
    entries = F.map_from_entries(F.collect_list(F.struct("k", "s")))
    return sums.groupBy(key).agg(entries.alias("held"), F.sum("s").alias("total"))


def _count(held: str, k: Column) -> Column:
    return F.coalesce(F.try_element_at(F.col(held), k), F.lit(0.0))


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def gather(evidence: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Log priors by host, and log likelihoods of declared languages and address suffixes.

    ``evidence`` has ``host, declared, suffix, text_evidence`` of all rows; rows
    whose text says nothing or is in an unknown language don't count. Each table
    has a row for a value and its array over languages. Groups are combined
    before they are shuffled.
    """
    post = _posterior(F.slice("text_evidence", 1, size))
    spoken = evidence.filter((F.get("text_evidence", F.lit(size)) > 0) & (_unknown(size) <= 0))
    spoken = spoken.select("host", "declared", "suffix", F.posexplode(post).alias("k", "p")).filter("p > 1e-12")

    def sums(column: str) -> DataFrame:
        return spoken.filter(F.col(column).isNotNull()).groupBy(column, "k").agg(F.sum("p").alias("s"))

    by_host = stage(sums("host"))
    by_domain = by_host.groupBy(_domain(F.col("host")).alias("_domain"), "k").agg(F.sum("s").alias("s"))
    hosts, domains = _held(by_host, "host"), stage(_held(by_domain, "_domain"))
    whole = {row["k"]: row["s"] for row in spoken.groupBy("k").agg(F.sum("p").alias("s")).collect()}
    total = sum(whole[k] for k in sorted(whole))
    general = [(whole.get(k, 0.0) + 1) / (total + size) for k in range(size)]
    base = F.array(*map(F.lit, general))

    def share(k: Column) -> Column:
        above = (_count("d.held", k) + SMOOTHING * F.get(base, k)) / (F.col("d.total") + SMOOTHING)
        return F.log((_count("h.held", k) + SMOOTHING * above) / (F.col("h.total") + SMOOTHING))

    priors = hosts.alias("h").join(domains.alias("d"), _domain(F.col("h.host")) == F.col("d._domain"))
    priors = priors.select(F.col("h.host").alias("host"), _each(size, share).alias("host_evidence"))

    def given(column: str) -> DataFrame:
        # A value's share of a language's rows, smoothed towards its share of all rows.
        def each(k: Column) -> Column:
            overall = SMOOTHING * F.col("total") / max(total, 1.0)
            return F.log((_count("held", k) + overall) / (F.get(base, k) * total + SMOOTHING))

        return stage(_held(sums(column), column).select(column, _each(size, each).alias(f"{column}_evidence")))

    return stage(priors), given("declared"), given("suffix")


def decide(rows: DataFrame, model: Model, tables: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Adds ``language, confidence, accepted`` to rows that have ``text_evidence`` and the keys of ``tables``.

    The confidence is the posterior of the best language, an unknown one being
    a choice that only the text speaks for or against. The tables are left to
    Spark to broadcast if they are small; a hot host's rows are split by
    adaptive execution otherwise.
    """
    size = len(model.languages)
    if not size:
        return rows.withColumns(
            {"language": F.lit(None).cast("string"), "confidence": F.lit(0.0), "accepted": F.lit(False)}
        )
    hosts, declared, suffixes = tables
    joined = rows.join(hosts, "host", "left").join(declared, "declared", "left").join(suffixes, "suffix", "left")
    parts = ("text_evidence", "host_evidence", "declared_evidence", "suffix_evidence")
    scores = _each(size, lambda k: sum((F.coalesce(F.get(p, k), F.lit(0.0)) for p in parts), F.lit(0.0)))
    fused = joined.withColumn("_post", _posterior(scores)).withColumn("_best", F.array_max("_post"))
    fused = fused.withColumn("confidence", F.col("_best") / (1 + F.exp(_unknown(size))))
    names = F.array(*[F.lit(x) for x in model.languages])
    known = F.get("text_evidence", F.lit(size)) > 0
    best = F.get(names, F.array_position("_post", F.col("_best")).cast("int") - 1)
    return (
        fused.withColumn("language", F.when(known, best))
        .withColumn("accepted", known & (F.col("confidence") >= ACCEPT))
        .drop("_post", "_best", "host_evidence", "declared_evidence", "suffix_evidence")
    )


def visible_text(html: Column) -> Column:
    """What a page shows: scripts, styles, comments and tags become spaces."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def document_evidence(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, host, declared, suffix, text_evidence``: the source stands for the host, ``lang`` is declared."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("host"),
        main_language(F.col("lang")).alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        text_evidence(F.col("text"), model, docs.sparkSession).alias("text_evidence"),
    )


def page_evidence(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id`` and the same of web pages: markup's language, host, and the address's ends."""
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    place = F.lower(F.regexp_extract("url", r"://[^/?#]*/([A-Za-z]{2})(?=[/?#]|$)", 1))
    declared = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        "page_id",
        F.when(host != "", host).alias("host"),
        F.when(declared != "", declared).alias("declared"),
        F.when(host != "", F.concat_ws("/", F.substring_index(host, ".", -1), place)).alias("suffix"),
        text_evidence(visible_text(F.col("html")), model, pages.sparkSession).alias("text_evidence"),
    )


def languages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``doc_id, page_id, language, confidence, accepted`` of every document and every page.

    A row is accepted if its language's posterior is at least ACCEPT and its
    text has words; without words the language is null. A text that is unusual in
    its best language, as noise and languages that weren't learned are, has a low
    posterior whatever its declaration, suffix and host. Missing or unseen
    declarations, suffixes and hosts say nothing. Rows stay apart, also equal
    ones and those without id. With no document to learn from nothing is
    accepted; empty tables give no rows. Other columns aren't read.
    """
    model = fit(docs)
    out = None
    kinds = (
        (document_evidence(docs, model), "page_id"),
        (page_evidence(pages, model), "doc_id"),
    )
    for rows, missing in kinds:
        evidence = stage(rows)
        tables = gather(evidence, len(model.languages)) if model.languages else ()
        found = decide(evidence, model, tables).withColumn(missing, F.lit(None).cast("long"))
        found = found.select("doc_id", "page_id", "language", "confidence", "accepted")
        out = found if out is None else out.union(found)
    return out
