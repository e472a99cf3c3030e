"""Language-model scores: Katz backoff with Good-Turing discounts, normalised exactly.

A text is the sequence of a begin, its words and an end. An n-gram seen c times
has the probability d(c) * c / c(context), d being the Good-Turing discount for
counts up to DISCOUNTED; one that wasn't seen has the context's backoff weight
times the probability of the shorter n-gram, down to single tokens and, for an
unknown word, the mass that the discounts of all tokens set free. A context's
weight is what its discounts set free over the sum of the shorter probabilities
of the tokens it wasn't seen with; both sums are taken over the n-grams
themselves, so each context's probabilities add up to 1.

Tables hold n-grams as 64-bit hashes and are partitioned by level and by ranges
of the hash. Texts are cut into blocks of whole texts, whose tokens are written
once, in buckets; every question a block has goes to the parts as its distinct
n-grams in ascending order, as packed differences, and the answer comes back as
one number for each. So what is shuffled are distinct n-grams of blocks, a few
bytes each, and never the tokens; a hot word or pair is one entry of a block.

1. Blocks send n-grams of all levels and their training counts; parts add them
   up and answer with the counts. One of the blocks that share an n-gram owns it.
2. For each level, blocks send the contexts' sums over the n-grams they own;
   parts add them up and answer with backoff weights.
3. Blocks evaluate their tokens level by level.

Only the counts of counts, a few numbers for each level, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab.llm.common import WordHashes, mix, release, spaced_words, texts_as_bytes
from txlab.sources.staging import stage, stage_in_buckets

ORDER = 2
#: Counts up to here are discounted.
DISCOUNTED = 5
#: Tokens after which a block ends with the text at hand.
BLOCK_TOKENS = 2_500_000
#: Tokens of all texts for each part of a level, and the least number of parts.
PART_TOKENS = 500_000
LEAST_PARTS = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: A space and a newline are never part of a word.
_BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b" "))
_END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
_COUNTS, _WEIGHTS = 0, 1
_NO_BLOCK = -1


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, in no more bytes than the largest needs."""
    if values.dtype.kind != "f":
        most = int(values.max(initial=0))
        values = values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most < 1 << 8 * int(t[2:])))
    return bytes([values.itemsize]) + values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(raw: bytes, kind: str = "u") -> np.ndarray:
    size = raw[0]
    flat = np.frombuffer(raw, np.uint8, offset=1).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(f"<{kind}{size}").ravel()


def differences(keys: np.ndarray) -> bytes:
    """Ascending keys."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def from_differences(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw).astype(np.uint64), dtype=np.uint64)


_BLOCK_SCHEMA = "doc_ids array<long>, learn array<boolean>, sizes array<int>, words binary, tokens binary, n_tokens long"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of their block's words; the most frequent words have the smallest numbers."""
    hashes = WordHashes()
    doc_ids, learn, texts, held = [], [], [], 0

    def sent() -> pa.RecordBatch:
        tokens = np.concatenate(texts)
        words, number, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([learn], pa.list_(pa.bool_())),
                pa.array([list(map(len, texts))], pa.list_(pa.int32())),
                pa.array([planes(words[order])], pa.binary()),
                pa.array([planes(rank[number])], pa.binary()),
                pa.array([len(tokens)], pa.int64()),
            ],
            ["doc_ids", "learn", "sizes", "words", "tokens", "n_tokens"],
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "learn"))
        for doc_id, learned, text in zip(*columns, texts_as_bytes(batch.column("text"))):
            doc_ids.append(doc_id)
            learn.append(learned)
            texts.append(np.concatenate(([_BEGIN], hashes.of(spaced_words(text)), [_END])))
            held += len(texts[-1])
            if held >= BLOCK_TOKENS:
                yield sent()
                doc_ids, learn, texts, held = [], [], [], 0
    if texts:
        yield sent()
    release()


class Block:
    """The tokens of a block and, for each level, its distinct n-grams."""

    def __init__(self, row: dict, order: int):
        words, tokens = from_planes(row["words"]), from_planes(row["tokens"])
        sizes = np.asarray(row["sizes"], np.int64)
        self.number, self.doc_ids, self.sizes = row["block"], row["doc_ids"], sizes
        self.starts = np.concatenate(([0], np.cumsum(sizes[:-1]))).astype(np.int64)
        self.learn = np.asarray(row["learn"], bool)
        place = np.arange(len(tokens), dtype=np.int32) - np.repeat(self.starts, sizes).astype(np.int32)
        keys = words[tokens]
        ascending = np.argsort(words)
        rank = np.empty(len(words), np.int32)
        rank[ascending] = np.arange(len(words), dtype=np.int32)
        #: Of each level: distinct keys, the tokens that end an n-gram, and which of the keys it is.
        self.keys, self.at, self.which = [words[ascending]], [np.arange(len(tokens), dtype=np.int32)], [rank[tokens]]
        first = keys
        for level in range(2, order + 1):
            at = np.flatnonzero(place >= level - 1).astype(np.int32)
            longer = np.zeros_like(keys)
            longer[at] = mix(keys[at - 1] * _STEP + first[at])
            keys = longer
            distinct, which = np.unique(keys[at], return_inverse=True)
            self.keys.append(distinct)
            self.at.append(at)
            self.which.append(which.astype(np.int32))

    def training_counts(self, level: int) -> np.ndarray:
        weight = np.repeat(self.learn, self.sizes)[self.at[level - 1]]
        return np.bincount(self.which[level - 1][weight], minlength=len(self.keys[level - 1]))

    def contexts(self, level: int) -> np.ndarray:
        """The context of each n-gram of the level, as a number of the level below."""
        if level == 2:
            return self.which[0][self.at[1] - 1]
        below = np.full(len(self.at[0]), -1, np.int32)
        below[self.at[level - 2]] = self.which[level - 2]
        return below[self.at[level - 1] - 1]


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the ranges of the parts begin and end in ascending keys."""
    low = [(p * (1 << 32) + parts - 1) // parts for p in range(parts)]
    return np.append(np.searchsorted(keys, np.asarray(low, np.uint64) << np.uint64(32)), len(keys))


def _questions(block: Block, level: int, parts: int, values: list[np.ndarray]) -> Iterator[tuple]:
    """``level, part, block, keys`` and the values, part by part."""
    keys = block.keys[level - 1]
    cuts = _cuts(keys, parts).tolist()
    for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield level, part, block.number, differences(keys[a:b]), *(planes(v[a:b]) for v in values)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_COUNT_QUESTION = pa.schema(
    [("level", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())]
)
_SUM_QUESTION = pa.schema([*_COUNT_QUESTION][:4] + [pa.field("freed", pa.binary()), pa.field("low", pa.binary())])
_ANSWER = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("level", pa.int32()), ("part", pa.int32()), ("values", pa.binary()), ("stats", pa.list_(pa.int64()))]
)
_ANSWER_SCHEMA = "block long, kind int, level int, part int, values binary, stats array<long>"


def _count_questions(order: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, order)
                for level in range(1, order + 1):
                    found = list(_questions(block, level, parts, [block.training_counts(level)]))
                    yield _batch(found, _COUNT_QUESTION)
        release()

    return run


def _gathered(table: pa.Table) -> tuple[list[dict], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a part by block, their keys, and of all keys: distinct ones, first places, numbers."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    keys = [from_differences(r["keys"]) for r in rows]
    distinct, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    return rows, keys, distinct, first, which


def _count_answers(table: pa.Table) -> pa.Table:
    """Twice the count of each n-gram, plus 1 for the block that owns it; and counts of counts."""
    rows, keys, distinct, first, which = _gathered(table)
    level, part = rows[0]["level"], rows[0]["part"]
    given = np.concatenate([from_planes(r["n"]) for r in rows])
    total = np.bincount(which, weights=given, minlength=len(distinct)).astype(np.int64)
    answer = 2 * total[which]
    answer[first] += 1
    out, start = [], 0
    for row, own in zip(rows, keys):
        out.append((row["block"], _COUNTS, level, part, planes(answer[start : start + len(own)]), None))
        start += len(own)
    tokens = total[distinct != _BEGIN] if level == 1 else total
    few = np.bincount(np.minimum(tokens, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
    stats = [int(tokens.sum()), int((tokens > 0).sum()), *few.tolist()]
    out.append((_NO_BLOCK, _COUNTS, level, part, b"", stats))
    return pa.Table.from_batches([_batch(out, _ANSWER)])


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """The discount of each count, 1 from DISCOUNTED + 1 on.

    Where the counts of counts give none between 0 and 1 (as in small tables),
    half an occurrence is taken off instead.
    """
    r = np.arange(1, DISCOUNTED + 1)
    n = np.asarray(counts_of_counts, float)
    out = (r - 0.5) / r
    if n.min() > 0:
        common = (DISCOUNTED + 1) * n[DISCOUNTED] / n[0]
        if common < 1:
            turing = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
            if (turing > 0).all() and (turing <= 1).all():
                out = turing
    return np.concatenate(([1.0], out, [1.0]))


@dataclass
class Totals:
    """What is known of all training tokens."""

    tokens: int
    words: int
    #: Of each level, the discounts by count, and what the discounts of single tokens set free.
    discounts: list[np.ndarray]
    freed: float

    @classmethod
    def of(cls, stats: dict[int, list[int]], order: int) -> "Totals":
        empty = [0] * (DISCOUNTED + 3)
        each = [stats.get(level, empty) for level in range(1, order + 1)]
        rates = [discounts(s[2:]) for s in each]
        few = np.arange(1, DISCOUNTED + 1) * np.asarray(each[0][2:-1], float)
        return cls(each[0][0], each[0][1], rates, float(((1 - rates[0][1:-1]) * few).sum()))

    def lowest(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a token with so many training occurrences; 0 of them: any unknown word."""
        if not self.tokens:
            return np.ones(len(counts))
        if not self.freed:
            return np.where(counts > 0, counts, 1) / (self.tokens + 1)
        rate = self.discounts[0][np.minimum(counts, DISCOUNTED + 1)]
        return np.where(counts > 0, rate * counts, self.freed) / self.tokens


class Evaluation:
    """Logarithms (base 10) of the probabilities of a block's tokens, raised level by level."""

    def __init__(self, block: Block, answers: list[dict], totals: Totals):
        self.block, self.totals = block, totals
        answers = sorted(answers, key=lambda r: (r["kind"], r["level"], r["part"]))
        self.given: dict[tuple[int, int], np.ndarray] = {}
        for kind, read in ((_COUNTS, "u"), (_WEIGHTS, "f")):
            for level in {r["level"] for r in answers if r["kind"] == kind}:
                parts = [from_planes(r["values"], read) for r in answers if (r["kind"], r["level"]) == (kind, level)]
                self.given[kind, level] = np.concatenate(parts)
        self.logs = np.log10(totals.lowest(self.counts(1)))[block.which[0]]

    def counts(self, level: int) -> np.ndarray:
        return (self.given[_COUNTS, level] >> 1).astype(np.int64)

    def sums(self, level: int) -> list[np.ndarray]:
        """Of each context of the level below, over the n-grams owned: what discounts free, shorter probabilities."""
        block, counts = self.block, self.counts(level)
        owned = np.flatnonzero((self.given[_COUNTS, level] & 1).astype(bool) & (counts > 0))
        some = np.zeros(len(counts), np.int32)
        some[block.which[level - 1]] = np.arange(len(block.at[level - 1]), dtype=np.int32)
        some = some[owned]
        context, n = block.contexts(level)[some], counts[owned]
        rate = self.totals.discounts[level - 1][np.minimum(n, DISCOUNTED + 1)]
        lower = 10.0 ** self.logs[block.at[level - 1][some]]
        size = len(block.keys[level - 2])
        return [np.bincount(context, weights=w, minlength=size).astype(float) for w in ((1 - rate) * n, lower)]

    def raise_to(self, level: int) -> None:
        """From the probabilities of the level below to those of this one."""
        block, n = self.block, self.counts(level)[self.block.which[level - 1]]
        context = block.contexts(level)
        around, weight = self.counts(level - 1)[context], self.given[_WEIGHTS, level - 1][context]
        # A negative weight: no discounted n-grams, hence one more occurrence is assumed.
        around = around + (weight < 0)
        rate = self.totals.discounts[level - 1][np.minimum(n, DISCOUNTED + 1)]
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10(rate * n / around)
            back = np.where(self.counts(level - 1)[context] > 0, np.log10(np.abs(weight) / around), 0.0)
        at = block.at[level - 1]
        self.logs[at] = np.where(n > 0, seen, back + self.logs[at])


def _sum_questions(level: int, parts: int, totals: Totals):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = Block(row, level)
            state = Evaluation(block, right.to_pylist(), totals)
            for lower in range(2, level):
                state.raise_to(lower)
            out += _questions(block, level - 1, parts, state.sums(level))
        return pa.Table.from_batches([_batch(out, _SUM_QUESTION)] if out else [], _SUM_QUESTION)

    return run


def _sum_answers(table: pa.Table) -> pa.Table:
    """Backoff weights times the contexts' counts; negative where no discount frees anything."""
    rows, keys, distinct, _, which = _gathered(table)
    freed, low = (
        np.bincount(which, weights=np.concatenate([from_planes(r[c], "f") for r in rows]), minlength=len(distinct))
        for c in ("freed", "low")
    )
    weight = np.where(freed > 0, freed, -1.0) / np.maximum(1 - low, np.finfo(float).tiny)
    answer, out, start = weight[which], [], 0
    for row, own in zip(rows, keys):
        out.append((row["block"], _WEIGHTS, row["level"], row["part"], planes(answer[start : start + len(own)]), None))
        start += len(own)
    return pa.Table.from_batches([_batch(out, _ANSWER)])


_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _scores(order: int, totals: Totals):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = Block(row, order)
            state = Evaluation(block, right.to_pylist(), totals)
            for level in range(2, order + 1):
                state.raise_to(level)
            token = np.ones(len(state.logs), bool)
            token[block.starts] = False
            n = state.counts(1)[block.which[0]]
            base = np.log10((n + 0.5) / (totals.tokens + 0.5 * (totals.words + 1)))
            known, base, score = (np.add.reduceat(x * token, block.starts) for x in ((n > 0).astype(np.int64), base, state.logs))
            columns = [block.doc_ids, ~block.learn, block.sizes - 1, known, np.full(len(known), totals.tokens), base, score]
            out.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES)], schema=_SCORES))
        return pa.Table.from_batches(out, _SCORES)

    return run


def katz_scores(docs: DataFrame, learn: Column, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    The model of n-grams up to ``order`` (2 or more) learns from the rows where
    ``learn`` holds; all others, also those where it is null, are held out.
    ``score`` is its log10 probability of the text's words and end, ``base_score``
    that of single tokens with half an occurrence added; ``n_known`` counts
    tokens seen in training, ``train_tokens`` all training tokens.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased, and are told apart
    by 64-bit hashes. A null or empty text is only its end. Rows stay apart, also
    equal ones (each counts in training) and those without doc_id. Texts are
    never cut. Only ``doc_id``, ``text`` and what ``learn`` names are read.
    Without training rows every token is unknown with probability 1; an empty
    table gives no rows.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col("text").cast("string").alias("text"),
    )
    numbered = rows.mapInArrow(_blocks, _BLOCK_SCHEMA).withColumn("block", F.monotonically_increasing_id())
    blocks = stage_in_buckets(numbered, int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-tokens // PART_TOKENS))
    asked = blocks.mapInArrow(_count_questions(order, parts), "level int, part int, block long, keys binary, n binary")
    counted = stage(asked.groupBy("level", "part").applyInArrow(_count_answers, _ANSWER_SCHEMA))
    each = [F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(DISCOUNTED + 3)]
    stats = {r[0]: list(r)[1:] for r in counted.filter(F.col("block") == _NO_BLOCK).groupBy("level").agg(*each).collect()}
    totals = Totals.of(stats, order)
    answers = counted.filter(F.col("block") != _NO_BLOCK).drop("stats")
    for level in range(2, order + 1):
        sums = (
            blocks.groupBy("block")
            .cogroup(answers.filter(F.col("level") <= level).groupBy("block"))
            .applyInArrow(
                _sum_questions(level, parts, totals),
                "level int, part int, block long, keys binary, freed binary, low binary",
            )
        )
        weights = stage(sums.groupBy("level", "part").applyInArrow(_sum_answers, _ANSWER_SCHEMA))
        answers = answers.unionByName(weights.drop("stats"))
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _scores(order, totals),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
