"""Near-duplicate groups: SuperMinHash signatures, bands, checked links, components.

A document is the set of its word shingles. Documents with the same set form a
class, of which only the smallest doc_id goes on. Its SuperMinHash signature
takes, for each place, the smallest of the ranks that the elements' random
permutations give it. Ranks of level j lie in [j, j + 1), so levels are worked
through for all elements at once until every place holds a rank below the next
level (early stop); large sets need one or two.

Signatures are cut into bands. Classes that agree in a band are candidates.
Each is compared with the smallest of its bucket first; then whatever pairs of
*different* components a bucket still holds are decided: in buckets of few rows
one by one, in larger ones through the shingles in which a member differs from
the head of the bucket's largest component (see ``_pairs_by_edits``), which
needs no pair that shares no such edit. Every link is confirmed on full sets,
and links are grouped by union-find. With 32 bands of 4 ranks a pair at 0.8 is
missed with a chance of 5e-8.

Facts of a group are written before they are joined to its rows: Spark then
broadcasts them if they are small, and else can split a hot group's rows.

What is shuffled: 32 band keys a class, candidate pairs, the edits of members of
large mixed buckets, and the texts of documents in candidate pairs. No bucket is
gathered in one task, and pairs inside a component are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.llm.common import WordHashes, ids_and_texts, mix, release, spaced_words, text_key, texts_as_bytes
from txlab.llm.components import components
from txlab.sources.staging import stage

PLACES = 128
ROWS_PER_BAND = 4
#: Buckets of at most so many rows are compared pair by pair.
DIRECT_ROWS = 12
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text_words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than ``size`` are one shingle."""
    n = len(text_words)
    if not n:
        return np.empty(0, np.uint64)
    each, span = hashes.of(text_words), min(n, size)
    with np.errstate(over="ignore"):
        out = mix(each[: n - span + 1] + np.uint64(span))
        for k in range(1, span):
            out = mix(out * _STEP + each[k : n - span + 1 + k])
    return np.unique(out)


def superminhash(elements: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signature of a non-empty set of distinct 64-bit hashes."""
    n = len(elements)
    least = np.full(places, np.inf)
    taken = None
    with np.errstate(over="ignore"):
        for level in range(places):
            draw = mix(elements + np.uint64(level + 1) * _STEP)
            rank = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + level
            pick = (mix(draw) % np.uint64(places - level)).astype(np.int64) + level
            if level == 0:
                place = first = pick
            else:
                if taken is None:  # the permutations so far, one row for each element
                    taken = np.tile(np.arange(places, dtype=np.int32), (n, 1))
                    every = np.arange(n)
                    taken[every, first] = 0
                    taken[:, 0] = first
                place = taken[every, pick]
                taken[every, pick] = taken[:, level]
                taken[:, level] = place
            np.minimum.at(least, place, rank)
            if least.max() < level + 1:
                break
    return least


def band_keys(signature: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    parts = signature.view(np.uint64).reshape(-1, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, len(parts) + 1, dtype=np.uint64) * _STEP
        for k in range(rows):
            key = mix(key ^ parts[:, k])
    return key.view(np.int64)


def _features(size: int, places: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            counts, sets, bands = [], [], []
            for text in texts_as_bytes(batch.column("text")):
                elements = shingle_hashes(spaced_words(text), size, hashes)
                counts.append(len(elements))
                if len(elements):
                    sets.append(xxhash.xxh3_128_digest(elements.tobytes()))
                    bands.append(band_keys(superminhash(elements, places), rows))
                else:
                    sets.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_text"),
                    pa.array(counts, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "_text", "n_shingles", "set_key", "bands"],
            )
        release()

    return run


def _similar(size: int, percent: int):
    """Rows of ids and texts of a pair to the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, left = None, None
        for batch in batches:
            keep = []
            for a, b in zip(texts_as_bytes(batch.column("text_a")), texts_as_bytes(batch.column("text_b"))):
                if a != last:
                    last, left = a, shingle_hashes(spaced_words(a), size, hashes)
                right = shingle_hashes(spaced_words(b), size, hashes)
                short, long = sorted((len(left), len(right)))
                both = 0
                if 100 * short >= percent * long and short:
                    both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(bool(both) and 100 * both >= percent * (short + long - both))
            kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if kept.num_rows:
                yield kept
        release()

    return run


def _links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are similar enough on their full sets.

    The pair's side of either join may be skewed, the text's side has a row for
    each id, so adaptive execution can split whatever is hot.
    """
    return stage(_with_texts(pairs, texts).mapInArrow(_similar(size, percent), "a long, b long"))


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    pairs = stage(pairs)
    with_a = pairs.join(texts, pairs.a == texts.id).select(*pairs.columns, F.col("text").alias("text_a"))
    return with_a.join(texts, with_a.b == texts.id).select(*pairs.columns, "text_a", F.col("text").alias("text_b"))


def _edits_of(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    schema = "a long, b long, component long, edits array<long>, weight long, limit long"
    return stage(_with_texts(pairs, texts).mapInArrow(_edits(size, percent), schema))


def _as_links(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _with_components(bands: DataFrame, groups: DataFrame) -> DataFrame:
    return bands.join(groups, bands.id == groups.node, "left").select(
        *bands.columns, F.coalesce("component", "id").alias("component")
    )


def _star_pairs(bands: DataFrame, percent: int) -> DataFrame:
    """Each class with the smallest of its bucket, if their sizes allow a link."""
    centres = stage(bands.groupBy("band").agg(F.min("id").alias("a")))
    sizes = bands.select(F.col("id").alias("a"), F.col("n").alias("n_a")).distinct()
    pairs = bands.join(centres, "band").filter("id <> a").select("a", F.col("id").alias("b"), "n").distinct()
    return pairs.join(sizes, "a").filter(_sizes_allow("n", "n_a", percent)).select("a", "b")


def _sizes_allow(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _open_buckets(bands: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component, with the bucket's size."""
    mixed = stage(
        bands.groupBy("band")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("held"))
        .filter("_low <> _high")
        .select("band", "held")
    )
    return bands.join(mixed, "band")


def _direct_pairs(bands: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in a bucket of few rows."""
    other = bands.select("band", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("_of"))
    return (
        bands.join(other, "band")
        .filter((F.col("component") != F.col("_of")) & (F.col("id") < F.col("b")) & _sizes_allow("n", "n_b", percent))
        .select(F.col("id").alias("a"), "b")
        .distinct()
    )


def _pivots(bands: DataFrame) -> DataFrame:
    """``a, b, component``: rows of large buckets, with the head of the bucket's largest component."""
    sizes = bands.groupBy("band", "component").count()
    heads = stage(sizes.groupBy("band").agg(F.max(F.struct("count", "component"))["component"].alias("a")))
    return (
        bands.join(heads, "band").select("a", F.col("id").alias("b"), "component").filter("a <> b").distinct()
    )


def _edits(size: int, percent: int):
    """A row of a pivot and a member to the shingles that only one of them has.

    ``weight`` is 100 times the pivot's shingles that the member lacks, plus
    ``percent`` times those it adds; ``limit`` is what a linked member's weight
    reaches at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, pivot = None, None
        for batch in batches:
            edits, weights, limits = [], [], []
            for a, b in zip(texts_as_bytes(batch.column("text_a")), texts_as_bytes(batch.column("text_b"))):
                if a != last:
                    last, pivot = a, shingle_hashes(spaced_words(a), size, hashes)
                member = shingle_hashes(spaced_words(b), size, hashes)
                both = len(np.intersect1d(pivot, member, assume_unique=True))
                edits.append(np.setxor1d(pivot, member, assume_unique=True).view(np.int64))
                weights.append(100 * (len(pivot) - both) + percent * (len(member) - both))
                limits.append((100 - percent) * len(pivot))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("a", "b", "component")),
                    pa.array(edits, pa.list_(pa.int64())),
                    pa.array(weights, pa.int64()),
                    pa.array(limits, pa.int64()),
                ],
                ["a", "b", "component", "edits", "weight", "limit"],
            )
        release()

    return run


def _pairs_by_edits(edits: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components around a pivot that may be similar enough.

    With the shingles of x and y that differ from the pivot's, ``100 *
    intersection >= percent * union`` means that x and y have at least
    (weight x + weight y - limit) / (100 + percent) such edits in common. In any
    fixed order of edits, a pair with that many in common shares one among the
    first of either, if all but the needed number (less one) count as first.
    Edits that no other component shares come first in the order, then the rarer.
    A pair of different components has a member whose weight exceeds the limit,
    so copies with few edits of their own need many in common with it.
    """
    part = 100 + percent
    rows = edits.select(
        "a", "b", "component", (F.col("weight") > F.col("limit")).alias("far"), F.size("edits").alias("n_edits"),
        "weight", "limit", F.explode("edits").alias("edit"),
    )
    shared = stage(
        rows.groupBy("a", "edit")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("held"))
        .filter("_low <> _high")
        .select("a", "edit", "held")
    )
    member = Window.partitionBy("a", "b")
    ranked = (
        rows.join(shared, ["a", "edit"])
        .withColumn("_place", F.row_number().over(member.orderBy("held", "edit")))
        .withColumn("_alone", F.col("n_edits") - F.count("*").over(member))
        .withColumn("_place", F.col("_place") + F.col("_alone"))
        .withColumn("_own", F.col("n_edits") - F.floor(F.col("weight") / part))
        .withColumn("_far", F.col("n_edits") - F.floor((F.col("weight") - F.col("limit")) / part))
    )
    first = stage(
        ranked.filter(F.col("_place") <= F.greatest("_own", F.when(F.col("far"), F.col("_far"))))
        .select(
            "a", "edit", "b", "component", "far", (F.col("_place") <= F.col("_own")).alias("near"),
            (F.col("n_edits") - F.col("_place")).alias("rest"), "weight", "limit",
        )
    )
    own = [c for c in first.columns if c not in ("a", "edit", "limit")]
    x = first.filter("far").withColumnsRenamed({c: f"{c}_x" for c in own})
    y = first.filter("near").drop("limit").withColumnsRenamed({c: f"{c}_y" for c in own})
    return (
        x.join(y, ["a", "edit"])
        .filter("component_x <> component_y AND (NOT far_y OR (near_x AND b_x < b_y))")
        # At the first edit in common, no more can follow than either has left.
        .filter(f"(least(rest_x, rest_y) + 1) * {part} >= weight_x + weight_y - limit")
        .select(F.least("b_x", "b_y").alias("a"), F.greatest("b_x", "b_y").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    places: int = PLACES,
    rows: int = ROWS_PER_BAND,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, _text, n_rows`` of each document.

    Two documents are linked if the sets of their ``size``-word shingles have
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest
    doc_id reachable over links, ``kept`` marks that document. ``_text`` is the
    text's hash, ``n_rows`` the number of equal rows. Only ``doc_id`` and
    ``text`` are read, whatever other columns there are.

    Null, empty and wordless texts have no shingles and are linked with nothing.
    A row without doc_id has no component and is kept. Rows with the same doc_id
    are one node of the links: equal texts give one row, different texts a row
    each with the same component. An empty table gives no rows.
    """
    source = ids_and_texts(docs).withColumn("_text", text_key(F.col("text")))
    features = stage(
        source.mapInArrow(
            _features(size, places, rows),
            "doc_id long, _text long, n_shingles long, set_key binary, bands array<long>",
        )
    )
    named = F.col("doc_id").isNotNull()
    full = features.filter(named & F.col("set_key").isNotNull())
    classes = stage(full.groupBy("set_key").agg(F.min("doc_id").alias("_class")))
    members = stage(
        full.join(classes, "set_key")
        .withColumn("bands", F.when(F.col("doc_id") == F.col("_class"), F.col("bands")))
        .drop("set_key")
    )
    bands = members.filter("bands IS NOT NULL").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band")
    )
    repeated = stage(bands.groupBy("band").count().filter("count > 1").select("band"))
    bands = stage(bands.join(repeated, "band", "left_semi"))
    texts = source.filter(named).select(F.col("doc_id").alias("id"), "text")
    # Different sets of one doc_id are one node, which links the sets' classes.
    several = (
        members.groupBy("doc_id")
        .agg(F.min("_class").alias("b"), F.max("_class").alias("_high"))
        .filter("b <> _high")
        .select("doc_id", "b")
    )
    found = stage(members.join(several, "doc_id").select(F.col("_class").alias("a"), "b"))
    links = _links(_star_pairs(bands, percent), texts, size, percent)
    groups = components(found.union(links))
    bands = stage(_open_buckets(_with_components(bands, groups)))
    few = F.col("held") <= DIRECT_ROWS
    around = _edits_of(_pivots(bands.filter(~few)), texts, size, percent)
    links = _links(_direct_pairs(bands.filter(few), percent), texts, size, percent).union(
        around.filter("weight <= limit").select("a", "b")
    )
    groups = components(_as_links(groups).union(links))
    moved = F.coalesce(groups.component, around.component)
    around = around.join(groups, around.b == groups.node, "left").select(
        "a", "b", moved.alias("component"), "edits", "weight", "limit"
    )
    links = _links(_pairs_by_edits(around, percent), texts, size, percent)
    groups = components(_as_links(groups).union(links))
    linked = members.select("doc_id", "_text", "n_shingles", "_class").join(
        groups, F.col("_class") == F.col("node"), "left"
    )
    result = linked.select("doc_id", "_text", "n_shingles", F.coalesce("component", "_class").alias("component_id"))
    alone = features.filter(~named | F.col("set_key").isNull()).select(
        "doc_id", "_text", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        result.union(alone)
        .groupBy("doc_id", "n_shingles", "component_id", "_text")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
