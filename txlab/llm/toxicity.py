"""Toxicity from the nearest labelled examples by TF-IDF cosine.

Fitting takes a bounded sample of labelled documents: at most EXAMPLES of each
class, the ones with the smallest hash of their id, of near copies the one with
the smallest id, as far as they have MOST_POSTINGS words together. All their
words are terms, known by a 64-bit hash. A term's weight is its inverse document
frequency, counted over all documents, times its strength: near 1 if it sets the
classes of the sample apart (chi-squared), LEAST_STRENGTH if it doesn't.

Scoring: an inverted index holds each term's weights in the examples. Examples
stand in blocks, with the largest weight of each term in each block. Terms of few
examples are added up list by list; those of many are stored by block, and their
largest weights bound every cosine in a block. The blocks with the highest bounds
are opened first; then all whose bound reaches the NEIGHBOURS-th best cosine. So
the nearest examples are exact, for every text that shares a word with any. Their
votes, by inverse distance and weighted back to the classes' true shares, give
the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.llm.common import WordHashes, ids_and_texts, release, texts_as_bytes, words
from txlab.llm.near_duplicates import shingle_hashes
from txlab.sources.staging import stage

EXAMPLES = 2_500
MOST_POSTINGS = 4_000_000
NEIGHBOURS = 15
BLOCK = 64
#: Terms of at least this share of the examples are stored by block.
COMMON_SHARE = 1 / 32
LEAST_STRENGTH = 0.1
#: Chi-squared of a term of half strength.
HALF_STRENGTH = 20.0
#: Blocks of each text that are opened first.
FIRST_BLOCKS = 4
_KEPT_WORDS = 200_000
_TEXTS_AT_ONCE = 250


class Numbers(dict):
    """The number of a word's term, -1 for a word of no example; forgets words when it holds many."""

    def __init__(self, hashes: np.ndarray):
        super().__init__()
        self.table = dict(zip(hashes.tolist(), range(len(hashes))))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        number = self[word] = self.table.get(xxhash.xxh3_64_intdigest(word), -1)
        return number

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the text's terms, and how often it has each."""
        found = Counter(map(self.__getitem__, words(text)))
        found.pop(-1, None)
        n = len(found)
        return np.fromiter(found.keys(), np.int64, n), np.fromiter(found.values(), np.float64, n)


@dataclass
class Model:
    #: Ascending hashes of the terms, and their weights.
    hashes: np.ndarray
    weights: np.ndarray
    #: Of each term: its place among the common ones or -1, and else where its examples and weights there are.
    common: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    #: Weights of the common terms by block, term, example, and the largest of each term and block.
    dense: np.ndarray
    most: np.ndarray
    toxic: np.ndarray
    ids: np.ndarray
    #: What a vote of either class counts.
    share: tuple[float, float]
    #: Score of a text without neighbours.
    base: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sketch():
    """The least hash of a text's three-word runs: near copies mostly share it, other texts hardly ever."""

    @F.arrow_udf("long")
    def sketch(texts: pa.Array) -> pa.Array:
        hashes = WordHashes()
        found = (shingle_hashes(words(text), 3, hashes) for text in texts_as_bytes(texts))
        return pa.array([int(each[0] >> np.uint64(1)) if len(each) else 0 for each in found], pa.int64())

    return sketch


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ascending hashes and counts of each example's words."""
    for batch in batches:
        terms, counts = [], []
        for text in texts_as_bytes(batch.column("text")):
            hashes = WordHashes().of(words(text))
            distinct, n = np.unique(hashes, return_counts=True)
            terms.append(distinct)
            counts.append(n.astype(np.uint32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("toxic"),
                pa.array([t.tobytes() for t in terms], pa.binary()),
                pa.array([n.tobytes() for n in counts], pa.binary()),
                pa.array(list(map(len, terms)), pa.int64()),
            ],
            ["doc_id", "toxic", "terms", "counts", "n"],
        )


def _document_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Numbers(shared.value)
        counts = np.zeros(len(shared.value) + 1, np.int64)  # the last place: words of no example
        for batch in batches:
            for text in texts_as_bytes(batch.column("text")):
                numbers = set(map(found.__getitem__, set(words(text))))
                counts[list(numbers)] += 1
        terms = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(counts[terms])], ["term", "n"])
        del found
        release()

    return run


def _document_frequencies(docs: DataFrame, hashes: np.ndarray) -> np.ndarray:
    shared = docs.sparkSession.sparkContext.broadcast(hashes)  # MOST_POSTINGS numbers at most
    rows = docs.select("text").mapInArrow(_document_counts(shared), "term int, n long")
    found = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(hashes))
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return out


def _examples(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """The sample's ``doc_id, toxic, terms, counts, n``, bounded in rows and in terms."""
    order = F.xxhash64("doc_id", F.lit("example"))
    sample = [usable.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(EXAMPLES) for c in (0, 1)]
    # At most 2 * EXAMPLES rows of two numbers, hence broadcast.
    chosen = F.broadcast(stage(sample[0].union(sample[1])))
    labelled = ids_and_texts(docs).join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    # Copies of one text would make its rare words look telling, and vote several times.
    first = F.min(F.struct("doc_id", "text")).alias("first")
    once = labelled.withColumn("_sketch", _sketch()(F.col("text"))).groupBy("toxic", "_sketch").agg(first)
    schema = "doc_id long, toxic int, terms binary, counts binary, n long"
    counted = stage(once.select("first.*", "toxic").mapInArrow(_example_terms, schema)).filter("n > 0")
    upto = F.sum("n").over(Window.partitionBy("toxic").orderBy(order, "doc_id"))
    return counted.withColumn("_upto", upto).filter(F.col("_upto") <= MOST_POSTINGS // 2).drop("_upto")


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """A model from the labels of the rows where ``learn`` holds.

    ``labels`` has ``doc_id, toxic``; rows without either are left out, and a
    doc_id labelled both ways is toxic; of documents that share a doc_id the
    smallest text counts. Without usable examples of both classes every text
    gets the same score.
    """
    usable = labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = {row["toxic"]: row["n"] for row in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    base = (total.get(1, 0) + 1) / (sum(total.values()) + 2)
    examples = _examples(docs, usable).collect()
    sizes = Counter(e["toxic"] for e in examples)
    if len(sizes) < 2:
        return _model(np.empty(0, np.uint64), np.empty(0), [], (1.0, 1.0), base)
    terms = [np.frombuffer(e["terms"], np.uint64) for e in examples]
    hashes, number = np.unique(np.concatenate(terms), return_inverse=True)
    toxic = np.repeat([e["toxic"] for e in examples], list(map(len, terms)))
    held, bad = (np.bincount(x, minlength=len(hashes)) for x in (number, number[toxic == 1]))
    share = sizes[1] / len(examples)
    chi = (bad - held * share) ** 2 / (held * share * (1 - share))
    strength = LEAST_STRENGTH + (1 - LEAST_STRENGTH) * chi**2 / (chi**2 + HALF_STRENGTH**2)
    idf = np.log((docs.count() + 1) / (_document_frequencies(docs, hashes) + 1)) + 1
    cuts = np.cumsum(list(map(len, terms)))[:-1]
    counts = [np.frombuffer(e["counts"], np.uint32) for e in examples]
    rows = [(e["doc_id"], e["toxic"], n, c) for e, n, c in zip(examples, np.split(number, cuts), counts)]
    whole = sum(total.values()) / len(examples)
    votes = tuple(total[c] / sizes[c] / whole for c in (0, 1))
    return _model(hashes, strength * idf, rows, votes, base)


def vector(numbers: np.ndarray, counts: np.ndarray, term_weights: np.ndarray) -> np.ndarray:
    out = (1 + np.log(counts)) * term_weights[numbers]
    return out / np.sqrt((out * out).sum()) if len(out) else out


def _together(numbers: list[np.ndarray], vectors: list[np.ndarray], terms: int) -> list[int]:
    """An order in which examples that are near the same one stand together, so that blocks' bounds are tight."""
    if not numbers:
        return []
    flat, values, starts = np.concatenate(numbers), np.concatenate(vectors), np.cumsum([0, *map(len, numbers[:-1])])
    near = []
    for pivot in range(0, len(numbers), BLOCK):
        weights = np.zeros(terms)
        weights[numbers[pivot]] = vectors[pivot]
        near.append(np.add.reduceat(values * weights[flat], starts))
    near = np.stack(near)
    return np.lexsort((-near.max(axis=0), near.argmax(axis=0))).tolist()


def _model(hashes: np.ndarray, term_weights: np.ndarray, rows: list[tuple], share: tuple, base: float) -> Model:
    vectors = [vector(numbers, counts, term_weights) for _, _, numbers, counts in rows]
    order = _together([r[2] for r in rows], vectors, len(hashes))
    blocks = -(-len(order) // BLOCK)
    numbers = np.concatenate([np.empty(0, np.int64), *(rows[k][2] for k in order)])
    values = np.concatenate([np.empty(0), *(vectors[k] for k in order)]).astype(np.float32)
    columns = np.repeat(np.arange(len(order), dtype=np.int32), [len(rows[k][2]) for k in order])
    held = np.bincount(numbers, minlength=len(hashes))
    many = held >= max(2.0, COMMON_SHARE * len(order))
    common = np.where(many, np.cumsum(many) - 1, -1)
    dense = np.zeros((int(many.sum()), blocks * BLOCK), np.float32)
    inside = many[numbers]
    dense[common[numbers[inside]], columns[inside]] = values[inside]
    dense = dense.reshape(len(dense), blocks, BLOCK)
    rare = np.flatnonzero(~inside)
    rare = rare[np.argsort(numbers[rare], kind="stable")]
    sizes = np.where(many, 0, held)
    return Model(
        hashes,
        term_weights,
        common,
        np.cumsum(sizes) - sizes,
        sizes,
        columns[rare],
        values[rare],
        np.ascontiguousarray(dense.transpose(1, 0, 2)),
        dense.max(axis=2, initial=0),
        np.asarray([rows[k][1] for k in order], np.int8),
        np.asarray([rows[k][0] for k in order], np.int64),
        share,
        base,
    )


class Scorer:
    """Nearest examples and scores of batches of texts."""

    def __init__(self, model: Model):
        self.model = model
        self.found = Numbers(model.hashes)
        #: Blocks met by the texts so far, and those of them that were opened.
        self.met, self.opened = 0, 0

    def _parts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Cosines as far as rare terms go, by example, and the weights of common terms."""
        model = self.model
        rare = np.zeros((len(texts), len(model.dense) * BLOCK), np.float32)
        common = np.zeros((len(texts), model.dense.shape[1]), np.float32)
        for row, text in enumerate(texts):
            numbers, counts = self.found.counts(text)
            weight = vector(numbers, counts, model.weights)
            place = model.common[numbers]
            common[row, place[place >= 0]] = weight[place >= 0]
            sizes = model.sizes[numbers]
            at = np.repeat(model.starts[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            added = model.values[at] * np.repeat(weight, sizes)
            rare[row] = np.bincount(model.columns[at], weights=added, minlength=rare.shape[1])
        return rare, common

    def nearest(self, texts: list[bytes], k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples of each text, best first; a cosine of 0 is no neighbour."""
        model, n, blocks = self.model, len(texts), len(self.model.dense)
        rare, common = self._parts(texts)
        bounds = rare.reshape(n, blocks, BLOCK).max(axis=2, initial=0) + common @ model.most
        bounds = bounds * (1 + 1e-5) + 1e-6
        cosines = np.zeros_like(rare)
        k = min(k, cosines.shape[1])

        def open_blocks(wanted: np.ndarray) -> None:
            self.opened += int(wanted.sum())
            for block in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, block])
                own = slice(block * BLOCK, (block + 1) * BLOCK)
                cosines[rows, own] = rare[rows, own] + common[rows] @ model.dense[block]

        first = np.zeros(bounds.shape, bool)
        some = min(FIRST_BLOCKS, blocks)
        np.put_along_axis(first, np.argpartition(-bounds, some - 1, axis=1)[:, :some], True, axis=1)
        open_blocks(first)
        reached = np.partition(cosines, -k, axis=1)[:, -k]
        open_blocks((bounds >= reached[:, None]) & ~first)
        self.met += bounds.size
        best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        found = np.take_along_axis(cosines, best, axis=1)
        order = np.lexsort((best, -found), axis=1)
        return np.take_along_axis(best, order, axis=1), np.take_along_axis(found, order, axis=1)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[int]]]:
        model = self.model
        if not texts or not len(model.ids):
            return np.full(len(texts), model.base), [[] for _ in texts]
        places, cosines = self.nearest(texts)
        near = cosines > 0
        places = np.minimum(places, len(model.ids) - 1)  # the last block is padded
        toxic = model.toxic[places] == 1
        distance = np.sqrt(np.maximum(0.0, 2 - 2 * cosines))
        votes = near * np.where(toxic, model.share[1], model.share[0]) / (0.1 + distance)
        score = ((votes * toxic).sum(axis=1) + model.base) / (votes.sum(axis=1) + 1)
        return score, [model.ids[p[m]].tolist() for p, m in zip(places, near)]


def score(text: Column, model: Model, spark) -> Column:
    """``score, neighbours`` of a text: 0 to 1, and the ids of the nearest examples.

    A text that shares no word with an example, as a null, empty or wordless
    one, has no neighbours and scores the share of toxic labels.
    """
    # Bounded by 2 * EXAMPLES and MOST_POSTINGS: a common term is in at least COMMON_SHARE of the examples.
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("score double, neighbours array<long>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, neighbours = [], []
            rows = list(texts_as_bytes(batch))
            for start in range(0, len(rows), _TEXTS_AT_ONCE):
                found = scorer.scores(rows[start : start + _TEXTS_AT_ONCE])
                scores.append(found[0])
                neighbours += found[1]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.empty(0), *scores])), pa.array(neighbours, pa.list_(pa.int64()))],
                ["score", "neighbours"],
            )
        del scorer
        release()

    return scored(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, neighbours`` of each row.

    Learns from the labels of rows that aren't held out (a fifth, by the
    checksum of doc_id). Rows stay apart, also equal ones; a row without doc_id
    isn't held out and is never learned from. Other columns of ``docs`` aren't
    read. No documents give no rows.
    """
    docs = ids_and_texts(docs)
    model = fit(docs, labels, ~held_out(F.col("doc_id")))
    scored = docs.select("doc_id", score(F.col("text"), model, docs.sparkSession).alias("_scored"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_scored.score").alias("score"),
        (F.col("_scored.score") >= 0.5).cast("int").alias("predicted"),
        F.col("_scored.neighbours").alias("neighbours"),
    )
