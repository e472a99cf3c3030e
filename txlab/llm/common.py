"""What several corpus operators share: words of a text, hashes of words and texts as bytes."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps every byte that is not part of a word to a space, and A-Z to a-z. Bytes from
#: 0x80 on belong to letters beyond ASCII, which count as parts of words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased."""
    return text.lower().split()


_held: dict = {}


def held_in_worker(key, make):
    """What ``make`` gives, kept in this Python worker for its next tasks.

    A worker keeps one such thing: the next operator's takes the place of the
    last one's, so what workers hold doesn't add up over the stages of a job.
    """
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Forget what this worker holds, as idle workers stay alive for a while."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


class WordHashes(dict):
    """64-bit hash of a word; forgets all words when it holds ``limit`` of them."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text_words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, text_words), np.uint64, len(text_words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_as_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, a null being an empty text; the column is not copied."""
    for value in column:
        raw = value.as_buffer()
        yield raw.to_pybytes() if raw is not None else b""


_shipped: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """What the operators' Python workers need of a session.

    Rows go to them in batches of 1,000 instead of 10,000, unless the session
    has a number of its own: long texts make batches large, and an executor
    holds several. In local mode workers can import this package wherever they
    start; on a cluster it is installed with the job, as any other.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    context = spark.sparkContext
    if context.master.startswith("local[") and context.applicationId not in _shipped:
        context.addFile(str(Path(__file__).resolve().parents[1]), recursive=True)
        _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_key(text: Column) -> Column:
    """Tells texts with the same id apart; a null differs from an empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())
