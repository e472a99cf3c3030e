"""Benchmark passages in documents, found by winnowing.

Of the hashes of all runs of GRAM words, the smallest of every WINDOW runs in a
row is kept, with its place. A passage that holds GRAM + WINDOW - 1 = SPAN words
of an item then shares a kept hash with the item, at the same place of the
passage. Kept hashes of documents meet those of the items; each hit is extended
word by word to both sides, and counts if the common words around it are at
least SPAN. Items of fewer words are one passage as a whole and are compared
through the hash of all their words.

The items' kept hashes are the side that is broadcast, in blocks bounded in rows
and in bytes, so that no passage, however many documents share it, is ever a
shuffle key. Only hits and one row for each document are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.llm.common import ids_and_texts, text_key
from txlab.sources.staging import stage

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1
#: Kept hashes of items in one broadcast, about 60 MB, and the bytes of the words around them.
BLOCK_ROWS = 200_000
BLOCK_BYTES = 1 << 26
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text: Column) -> Column:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text, A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces a text by ``words``; separators at either end leave no empty word."""
    parts = df.withColumn("words", word_list(F.col(text))).drop(text)
    first = F.when(F.get("words", F.lit(0)) == "", 2).otherwise(1)
    last = F.when((F.size("words") > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)
    return parts.withColumn("words", F.slice("words", first, F.greatest(F.size("words") - first + 1 - last, F.lit(0))))


def _grams(size: int) -> Column:
    """For each run of ``size`` words its hash, in the upper half, and its place."""
    starts = F.slice("words", 1, F.greatest(F.size("words") - (size - 1), F.lit(0)))

    def packed(word, place):
        value = F.hash(word, *[F.get("words", place + k) for k in range(1, size)])
        return F.shiftleft(value.cast("long"), 32).bitwiseOR(place.cast("long"))

    return F.transform(starts, packed)


def _least(values: Column, ahead: Column, by: int) -> Column:
    return F.zip_with(values, F.slice(ahead, by + 1, F.size(ahead)), lambda x, y: F.least(x, y))


def _winnowed(df: DataFrame, size: int, window: int) -> DataFrame:
    """``kept``: hash and place of the smallest hash of every ``window`` runs of ``size`` words."""
    df = df.withColumn("_grams", _grams(size))
    least, width = "_grams", 1
    while width * 2 <= window:
        df = df.withColumn(f"_least{width * 2}", _least(F.col(least), F.col(least), width))
        least, width = f"_least{width * 2}", width * 2
    if width < window:
        df = df.withColumn("_least", _least(F.col(least), F.col(least), window - width))
        least = "_least"
    return df.withColumn("kept", F.array_distinct(least))


def _fingerprints(df: DataFrame, short: list[int], full: bool) -> DataFrame:
    """``marks``: size, hash and place of what is kept, for the sizes that items have."""
    lists = []
    if full:
        df = _winnowed(df, GRAM, WINDOW)
        lists.append((SPAN, F.col("kept")))
    for size in short:
        df = df.withColumn(f"_grams{size}", _grams(size))
        lists.append((size, F.col(f"_grams{size}")))

    def with_span(size: int):
        return lambda mark: F.struct(F.lit(size).alias("span"), mark.alias("mark"))

    if len(lists) == 1:
        return df.withColumn("marks", lists[0][1]).withColumn("_span", F.lit(lists[0][0]))
    marks = [F.transform(kept, with_span(size)) for size, kept in lists]
    return df.withColumn("marks", F.concat(*marks)).withColumn("_span", F.lit(None).cast("int"))


def _exploded(df: DataFrame, columns: list[str], one: bool) -> DataFrame:
    mark = F.col("_mark") if one else F.col("_mark.mark")
    span = F.col("_span") if one else F.col("_mark.span")
    # With explode() Spark would add a filter on the lists and compute them again for it.
    return df.select(*columns, "words", "_span", F.explode_outer("marks").alias("_mark")).select(
        *columns,
        "words",
        span.alias("span"),
        F.shiftright(mark, 32).cast("int").alias("hash"),
        mark.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("place"),
    )


def _item_marks(items: DataFrame, short: list[int], full: bool) -> DataFrame:
    """The kept hashes of items, each with the words around it."""
    sides = []
    for size in short + ([SPAN] if full else []):
        own = items.filter(F.size("words") >= SPAN if size == SPAN else F.size("words") == size)
        marked = _fingerprints(own, [] if size == SPAN else [size], size == SPAN)
        out = _exploded(marked, ["item_id"], True).filter("place IS NOT NULL")
        reach = range(-(SPAN - GRAM), SPAN) if size == SPAN else range(size)
        around = F.array(*[F.get("words", F.col("place") + k) for k in reach])
        sides.append(out.select("item_id", "span", "hash", around.alias("around")))
    out = sides[0]
    for other in sides[1:]:
        out = out.union(other)
    return out


def _same(place: Column, k: int, offset: int) -> Column:
    """Whether the word ``k`` after the place is the item's; beyond either end it isn't."""
    here = F.get("words", F.col("place") + k)
    there = F.get("around", F.lit(k + offset))
    return F.coalesce(here == there, F.lit(False))


def _run(steps: list[int], offset: int) -> Column:
    """Words in a row that agree, from the first of ``steps`` on."""
    out = F.lit(len(steps))
    for n, k in reversed(list(enumerate(steps))):
        out = F.when(~_same(F.col("place"), k, offset), n).otherwise(out)
    return out


def _extended() -> tuple[Column, Column]:
    """First and last document word of a hit's passage, or null if it is too short."""
    beside = SPAN - GRAM
    core = F.lit(True)
    for k in range(GRAM):
        core = core & _same(F.col("place"), k, beside)
    before = _run([-k for k in range(1, beside + 1)], beside)
    after = _run(list(range(GRAM, SPAN)), beside)
    long_enough = core & (before + GRAM + after >= SPAN)
    whole = F.slice("words", F.col("place") + 1, F.col("span")) == F.col("around")
    full = F.col("span") == SPAN
    first = F.when(full & long_enough, F.col("place") - before).when(~full & whole, F.col("place"))
    last = F.when(full & long_enough, F.col("place") + GRAM - 1 + after).when(
        ~full & whole, F.col("place") + F.col("span") - 1
    )
    return first, last


def passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hits ``doc_id, _text, n_words, item_id, first, last``, and a row without item for each document.

    ``first`` to ``last`` are words of the document (from 0) that an occurrence
    of the item's passage covers; hits of one passage may overlap.
    """
    spark = docs.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    items = stage(with_words(items).filter(F.size("words") > 0))
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(SPAN))).distinct().collect()]
    short, full = sorted(n for n in lengths if n < SPAN), SPAN in lengths
    source = with_words(ids_and_texts(docs).withColumn("_text", text_key(F.col("text"))))
    own = source.select("doc_id", "_text", F.size("words").alias("n_words"))
    kinds = {"item_id": items.schema["item_id"].dataType, "first": "int", "last": "int"}
    none = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
    if not lengths:
        return own.select("*", *none)
    marks = stage(_item_marks(items, short, full))
    rows, size = marks.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.array_join("around", ""))), F.lit(0))).first()
    blocks = max(-(-rows // BLOCK_ROWS), -(-size // BLOCK_BYTES))
    kept = _fingerprints(source, short, full)
    one = len(lengths) == 1
    # An empty mark, which meets nothing, carries each document through the join.
    end = F.lit(None).cast("long")
    end = end if one else F.struct(F.lit(0).alias("span"), end.alias("mark"))
    kept = kept.withColumn("marks", F.concat(F.array(end), "marks"))
    rows = _exploded(kept, ["doc_id", "_text"], one)
    first, last = _extended()
    out = None
    for block in range(blocks):
        part = F.pmod(F.xxhash64("item_id", "hash", "around"), F.lit(blocks)) == block
        side = marks.filter(part) if blocks > 1 else marks
        alone = F.col("place").isNull() if block == 0 else F.lit(False)
        met = rows.join(F.broadcast(side), ["span", "hash"], "left")
        found = ["doc_id", "_text", F.size("words").alias("n_words"), "item_id"]
        hits = met.filter(alone | F.col("around").isNotNull()).select(
            *found, first.alias("first"), last.alias("last"), alone.alias("_alone")
        )
        hits = hits.filter("_alone OR first IS NOT NULL").drop("_alone")
        out = hits if out is None else out.union(hits)
    return out


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` of each document.

    A window is SPAN words in a row of an item of ``items`` (``item_id, text``),
    or all words of an item of fewer. ``n_hit`` counts the document's words in
    any occurrence of a window, ``items`` has the ids of items with windows that
    occur, as sorted texts. Only ``doc_id`` and ``text`` are read.

    Null, empty and wordless texts have no words and no hits; such items have no
    windows. Rows of equal doc_id and text are one document, rows without doc_id
    but with different texts are documents each. An item without id hits words
    but isn't counted. Without documents there are no rows; without items every
    document is clean.
    """
    each = Window.partitionBy("doc_id", "_text")
    before = F.max("last").over(each.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(before, F.lit(-1)))
    return (
        passages(docs, items)
        .distinct()
        .withColumn("_fresh", F.greatest(F.coalesce(fresh, F.lit(0)), F.lit(0)))
        .groupBy("doc_id", "_text")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.sum("_fresh").cast("long").alias("n_hit"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        .withColumns({"n_items": F.size("items").cast("long"), "contaminated": F.col("n_hit") > 0})
        .select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")
    )
