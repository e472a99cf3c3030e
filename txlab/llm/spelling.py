"""Spelling variants: words one edit apart, found by dense tiles of prefixes and suffixes.

Two words are near if their common prefix and common suffix together reach the
longer length minus one, and their lengths differ by one at most. Pairs are
compared in tiles: two blocks of words become padded matrices of code points,
and one sweep over the columns gives the common prefix lengths of all pairs of
the tile, one over the mirrored matrices the suffix lengths.

Which blocks meet: the place of an edit, counted by the common prefix, lies in
one of PIECES ranges of the longer length. Two words whose edit lies in a range
agree before and after it, so each word goes to one group for each range, keyed
by what is around the range; a pair counts only in the range that holds its
place, hence once. Groups of more than GROUP_ROWS words are not tiled but split:
their range is halved, which lengthens the part that must agree. A range of one
place holds at most one word for each letter of the alphabet, so this ends, and
no group is ever cut, capped or gathered whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.llm.common import ids_and_texts, texts_as_bytes
from txlab.sources.staging import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
DROP_EVERY = 31
LEAST_RATIO = 10
PIECES = 4
GROUP_ROWS = 2_048
TILE = 128
_KEPT_WORDS = 300_000
_KEPT_PAIRS = 100_000


def _runs(least: int):
    return re.compile("[a-zÀ-ÿ]{%d,}" % least).findall


def _counted(least: int, drop_every: int):
    """Words of each text and their numbers, added up over many texts before they are sent."""

    def sent(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, counts = _runs(least), Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_as_bytes(batch.column("text"))):
                seed = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
                for word, n in Counter(runs(text.lower().decode())).items():
                    if seed is not None:
                        mark = zlib.crc32(word.encode(), seed)
                        if mark % drop_every == 0:
                            cut = mark % len(word)
                            word = word[:cut] + word[cut + 1 :]
                            if len(word) < least:
                                continue
                    counts[word] += n
                if len(counts) >= _KEPT_WORDS:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words of all texts that occur ``least_count`` times.

    Runs of letters up to U+00FF, A-Z lower-cased; of one run in DROP_EVERY, by
    the checksum of doc_id and run, a code point is left out. Runs of rows
    without doc_id stay as they are.
    """
    found = ids_and_texts(docs).mapInArrow(_counted(least_length, DROP_EVERY), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _placed(rows: DataFrame) -> DataFrame:
    """The group of each row: what a word has before and after its range."""
    around = [F.expr("substring(word, 1, low)"), F.expr("right(word, size - high)")]
    return rows.withColumn("group", F.xxhash64("added", "size", "low", "high", *around))


def _first_ranges(words: DataFrame) -> DataFrame:
    """Every word in its roles: replaced letters (``added`` 0), the shorter or the longer of an insertion (1)."""
    length = F.char_length("word")
    roles = F.array(
        F.struct(F.lit(0).alias("added"), length.alias("size")),
        F.struct(F.lit(1).alias("added"), (length + 1).alias("size")),
        F.struct(F.lit(1).alias("added"), length.alias("size")),
    )
    rows = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    low, high = (F.expr(f"cast(size * (piece + {k}) div {PIECES} as int)") for k in (0, 1))
    return _placed(pieces.withColumn("low", low).withColumn("high", high).drop("piece").filter("low < high"))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.expr("cast((low + high) div 2 as int)")
    ends = F.array(
        F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("high").alias("b"))
    )
    split = rows.withColumn("half", F.explode(ends))
    return _placed(split.withColumn("low", F.col("half.a")).withColumn("high", F.col("half.b")).drop("half", "group"))


def _codes(words: list[str], mirrored: bool) -> np.ndarray:
    """One row of code points a word, padded with zeros to the longest."""
    width = max(map(len, words))
    padded = "".join(w[::-1].ljust(width, "\0") if mirrored else w.ljust(width, "\0") for w in words)
    return np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of ``left`` with every row of ``right``."""
    alive = np.ones((len(left), len(right)), bool)
    out = np.zeros(alive.shape, np.int32)
    for k in range(min(left.shape[1], right.shape[1])):
        alive &= left[:, k, None] == right[None, :, k]
        if not alive.any():
            break
        out += alive
    return out


def _tile(rows: dict, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs of two blocks, the first before the second."""
    before = _common(_codes(rows["word"][a], False), _codes(rows["word"][b], False))
    after = _common(_codes(rows["word"][a], True), _codes(rows["word"][b], True))
    length = np.maximum(rows["length"][a][:, None], rows["length"][b][None, :])
    same = np.abs(rows["length"][a][:, None] - rows["length"][b][None, :]) == rows["added"][a][:, None]
    for name in ("group", "added", "size", "low", "high"):
        same &= rows[name][a][:, None] == rows[name][b][None, :]
    # Where the letters around an edit repeat, the common prefix is its last possible place.
    place = np.minimum(before, length - 1)
    near = same & (before + after >= length - 1) & (place >= rows["low"][a][:, None]) & (place < rows["high"][a][:, None])
    if a == b:
        near = np.triu(near, 1)
    x, y = np.nonzero(near)
    return x + a.start, y + b.start


def _tiles(groups: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Block pairs that cover all groups: small groups share a block, a large one has several."""
    ends = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups))
    start, held = 0, 0
    for end in ends.tolist():
        if end - start > TILE:
            if held > start:
                yield slice(start, held), slice(start, held)
                start = held
            if end - start > TILE:
                blocks = [slice(k, min(k + TILE, end)) for k in range(start, end, TILE)]
                yield from ((a, b) for i, a in enumerate(blocks) for b in blocks[i:])
                start = end
        held = end
    if held > start:
        yield slice(start, held), slice(start, held)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, both ways, of rows that are sorted by size and group."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = {c: table.column(c).to_numpy() for c in ("n", "added", "size", "low", "high", "group")}
        rows["word"] = table.column("word").to_pylist()
        rows["length"] = np.fromiter(map(len, rows["word"]), np.int64, len(rows["word"]))
        words, out, held = table.column("word"), [], 0

        def sent() -> pa.RecordBatch:
            x, y = (np.concatenate(side) for side in zip(*out))
            both = np.concatenate((x, y)), np.concatenate((y, x))
            columns = [words.take(pa.array(both[0])), words.take(pa.array(both[1])), pa.array(rows["n"][both[1]])]
            return pa.table(columns, ["word", "near", "near_n"]).combine_chunks().to_batches()[0]

        for a, b in _tiles(rows["group"]):
            found = _tile(rows, a, b)
            if len(found[0]):
                out.append(found)
                held += len(found[0])
            if held >= _KEPT_PAIRS:
                yield sent()
                out, held = [], 0
        if held:
            yield sent()

    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        if table.num_rows < 4 * TILE:
            kept = table
            continue
        groups = table.column("group").to_numpy()
        last = np.flatnonzero(groups != groups[-1])  # the last group may go on
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield from pairs(table.slice(0, whole))
        kept = table.slice(whole)
    if kept is not None and kept.num_rows:
        yield from pairs(kept)


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` of every two words one edit apart, both ways; ``words`` has distinct ``word, n``."""
    rows, parts = _first_ranges(words), []
    while True:
        sizes = rows.filter("high - low > 1").groupBy("group").agg(F.count("*").alias("held"))
        large = stage(sizes.filter(F.col("held") > GROUP_ROWS).select("group"))
        if large.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(large, "group", "left_anti"))
        rows = stage(_halved(rows.join(large, "group", "left_semi")))
    columns = ["word", "n", "added", "size", "low", "high", "group"]
    found = None
    for part in parts:
        dealt = part.select(*columns).repartition("group").sortWithinPartitions("size", "group")
        pairs = dealt.mapInArrow(_near, "word string, near string, near_n long")
        found = pairs if found is None else found.union(pairs)
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows ``word, form``: forms are followed to the last one, by doubling steps."""
    roots = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("word").alias("_word"), F.col("root").alias("further"))
        moved = stage(roots.join(on, F.col("root") == F.col("_word"), "left").select("word", "root", "further"))
        if moved.filter("further IS NOT NULL").isEmpty():
            return roots
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of the texts.

    A word's form is the near word with the largest n (ties: the smallest in
    code-point order) if that is at least LEAST_RATIO times the word's own n,
    else null. The root is where forms lead to, the word itself without one.

    Rows without text have no words; equal rows count each. A text may be of any
    length, and so may a word. Only doc_id and text are read. An empty table, or
    one without such words, gives no rows.
    """
    words = stage(word_counts(docs, least_length, least_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    around = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best"))
    joined = words.join(around, "word", "left")
    fits = -F.col("_best.less") >= LEAST_RATIO * F.col("n")
    found = stage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("_best.form")).alias("form"),
            F.when(fits, -F.col("_best.less")).alias("form_n"),
        )
    )
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
