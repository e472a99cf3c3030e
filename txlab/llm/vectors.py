"""Vectors as whole-number matrices, packed into blocks and dealt out to parts, and searches of parts in rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlab.sources.staging import stage

#: Rows of a block hold at most so many bytes as 64-bit numbers.
BLOCK_BYTES = 1 << 21
#: Products up to here are exact in floating point.
EXACT = float(1 << 53)
#: Beyond every score.
ENDLESS = 1 << 62
#: A round of a search takes so many times as many parts as the one before.
ROUNDS_GROW = 8
FOUND = "number long, at long, slot long, vec_id long, score long"


def _matrices(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and floor(scale * x) of the vectors without null or non-finite components."""
    lists = batch.column("embedding")
    usable = np.asarray(lists.is_valid())
    offsets = lists.offsets.to_numpy()
    flat = lists.values
    good = np.asarray(flat.is_valid())
    values = np.where(good, flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), np.nan)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    sizes = np.diff(offsets)
    usable &= bad[offsets[1:]] == bad[offsets[:-1]]
    for size in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == size))
        step = max(1, BLOCK_BYTES // (8 * max(int(size), 1)))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            matrix = np.floor(scale * values[offsets[part][:, None] + np.arange(size)[None, :]])
            if matrix.size and np.abs(matrix).max() >= 2.0**62:
                raise ArithmeticError(f"a component times {scale:g} does not fit in 64 bits")
            yield int(size), part, matrix.astype(np.int64)


def _packed(scale: float, facts: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_matrices(batch, scale))
            if not found:
                continue
            columns = [pa.array([size for size, _, _ in found], pa.int32())]
            for fact in facts:
                values = batch.column(fact)
                columns.append(pa.array([values.take(pa.array(rows)).to_pylist() for _, rows, _ in found], pa.list_(pa.int64())))
            raw = [(m if m.size and np.abs(m).max() >= 1 << 15 else m.astype(np.int16)).tobytes() for _, _, m in found]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(raw, pa.binary())], ["dim", *facts, "matrix"])

    return run


def blocks(rows: DataFrame, scale: float, facts: list[str]) -> DataFrame:
    """``dim``, a list for each of the ``facts`` (long columns), ``matrix`` and ``number`` of each block, written.

    A block holds rows of one batch with vectors of one length; rows whose
    vector is null, or has a null or non-finite component, are left out.
    """
    schema = ", ".join(["dim int", *(f"{fact} array<long>" for fact in facts), "matrix binary"])
    packed = rows.select(*facts, "embedding").mapInArrow(_packed(scale, facts), schema)
    return stage(packed.withColumn("number", F.monotonically_increasing_id()))


def matrix(raw: bytes, rows: int, dim: int) -> np.ndarray:
    """A block's matrix as it was packed, in 16 or 64 bits."""
    return np.frombuffer(raw, np.int16 if len(raw) == 2 * rows * dim else np.int64).reshape(rows, dim)


def parts_of(held: DataFrame, most_bytes: int, tasks: int = 1) -> int:
    """The number of parts of blocks, of ``most_bytes`` or less so that ``tasks`` have one each."""
    total = held.agg(F.sum(F.length("matrix") + 1)).first()[0] or 1
    return max(1, -(-total // most_bytes), min(tasks, -(-total // (1 << 16))))


def part_of(number: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(parts)).cast("int")


def every_part(parts: int) -> Column:
    """A copy of a row for each part."""
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def tile(rows: pa.Table) -> dict[int, dict]:
    """The blocks of a tile by their vectors' length: lists end to end, ``starts`` of the blocks, and their ``rows``."""
    out: dict[int, dict] = {}
    listed = rows.to_pylist()
    for dim in sorted({r["dim"] for r in listed}):
        own = [r for r in listed if r["dim"] == dim]
        sizes = [len(r["vec_id"]) for r in own]
        facts = [c for c in ("vec_id", "label") if c in own[0]]
        out[dim] = {c: np.concatenate([np.asarray(r[c], np.int64) for r in own]) for c in facts}
        out[dim]["values"] = np.concatenate([matrix(r["matrix"], n, dim) for r, n in zip(own, sizes)])
        out[dim]["starts"], out[dim]["rows"] = np.cumsum([0, *sizes[:-1]]), own
    return out


def windows_of(asked: dict) -> np.ndarray:
    """Place in the tile, block, place in the block, slot, low and high of each window, by place."""
    every = [
        (start + w["at"], r["number"], w["at"], w["slot"], w["low"], w["high"])
        for start, r in zip(asked["starts"], asked["rows"])
        for w in r["windows"]
    ]
    return np.asarray(sorted(every), np.int64).reshape(-1, 6).T


def fill(
    windows: DataFrame, asked: DataFrame, asks: int, held: DataFrame, parts: int, k: int, search: Callable, once: bool = False
) -> DataFrame:
    """``number, at, slot, vec_id, score, rank``: the k best rows of each window, written.

    ``windows`` has ``number, at, slot, low, high``: the row ``at`` of an asked
    block looks for scores from ``low`` to ``high``. Asked blocks are in ``asks``
    groups, held ones in ``parts`` (their column ``part``). ``search`` gets a
    group of asked blocks with their windows and a part. Parts are searched in
    rounds, each ROUNDS_GROW times as many as before, and a full window's k-th
    score is its ``low`` in later rounds, so that what comes back doesn't grow
    with the number of parts. With ``once`` a vec_id counts once in a window.
    """
    window = ["number", "at", "slot"]
    found, start, step = None, 0, 1
    while start < parts:
        end = min(parts, start + step)
        now = windows
        if found is not None:
            full = found.filter(F.col("rank") == k).select(*window, F.col("score").alias("reached"))
            now = windows.join(full, window, "left").withColumn("low", F.greatest("low", "reached"))
        lists = now.groupBy("number").agg(F.collect_list(F.struct("at", "slot", "low", "high")).alias("windows"))
        looking = asked.join(lists, "number").withColumn("ask", part_of(F.col("number"), asks))
        looking = looking.withColumn("part", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        shown = held.filter(F.col("part").between(start, end - 1)).withColumn("ask", every_part(asks))
        keys = ["ask", "part"]
        more = looking.groupBy(*keys).cogroup(shown.groupBy(*keys)).applyInArrow(search, FOUND)
        more = more if found is None else more.unionByName(found.drop("rank"))
        if once:
            more = more.groupBy(*window, "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy(*window).orderBy(F.desc("score"), "vec_id"))
        found = stage(more.withColumn("rank", rank).filter(F.col("rank") <= k))
        start, step = end, step * ROUNDS_GROW
    return found
