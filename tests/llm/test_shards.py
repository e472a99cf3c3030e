"""Shards against prefix sums in plain Python, and odd rows."""

import random
import zlib

from txlab.llm.shards import shard


def brute(rows, shards):
    sized = sorted(
        ((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for d, t in rows)
    )
    total, before, slots, out = sum(r[3] for r in sized), 0, {}, []
    for known, doc, crc, size in sized:
        at = (2 * before + size) * shards // (2 * total)
        out.append((doc if known else None, size, crc, at, slots.get(at, 0)))
        slots[at] = slots.get(at, 0) + 1
        before += size
    return out


def test_prefix_sums(table):
    rng = random.Random(3)
    rows = [(rng.randrange(400), "é" * rng.randrange(50)) for _ in range(300)]
    rows += [(7, "same")] * 200 + [(None, "x"), (None, None), (5, None), (5, "")] + [(999, "long " * 2000)]
    for count in (1, 4, 16):
        got = sorted(tuple(r) for r in shard(table(rows).repartition(5), count).fillna(-1, "doc_id").collect())
        assert got == sorted((-1 if d is None else d, *rest) for d, *rest in brute(rows, count))


def test_few_rows(table):
    assert shard(table([]), 16).count() == 0
    assert [tuple(r) for r in shard(table([(1, None)]), 16).collect()] == [(1, 1, 0, 8, 0)]
