"""Token ids packed into sequences of one length, best fit first.

Each task encodes its documents and collects segments until it holds
WINDOW_TOKENS ids; these are packed and written out, so memory doesn't grow with
the input and nothing is shuffled. Segments go from the longest to the shortest
into the open sequence with the least room that is enough; a segment tree over
the rooms that open sequences have finds it in log(length) steps. Texts of more
ids than a sequence holds are cut into full sequences and a rest.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from txlab.llm.common import held_in_worker, ids_and_texts

LENGTH = 2048
WINDOW_TOKENS = 4_000_000
_SENT = 1024
#: Longer texts are encoded in blocks of about so many characters, which end where a match of the pattern does.
_BLOCK = 200_000


class RoomTree:
    """How many open sequences have each room, as a segment tree."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.counts[at] += n
            at >>= 1

    def least(self, need: int) -> int:
        """The least room of at least ``need``, or -1."""
        at = need + self.leaves
        if self.counts[at]:
            return need
        while at > 1:
            if not at & 1 and self.counts[at + 1]:
                at += 1
                while at < self.leaves:
                    at *= 2
                    if not self.counts[at]:
                        at += 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Sequences as lists of segment numbers, by best fit in decreasing size."""
    tree, open_at, sequences = RoomTree(length), {}, []
    for number in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[number]
        room = tree.least(size)
        if room < 0:
            room, at = length, len(sequences)
            sequences.append([])
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        sequences[at].append(number)
        if room > size:
            open_at.setdefault(room - size, []).append(at)
            tree.add(room - size, 1)
    return sequences


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _encoding(shared) -> tiktoken.Encoding:
    ranks, pattern = shared.value
    key = ("ranks", len(ranks), pattern, id(shared.value))
    return held_in_worker(
        key, lambda: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    )


def _ends(matches: regex.Pattern, text: str) -> Iterator[int]:
    """Where a long text's blocks end.

    Matching from a match's end goes on as in the whole text; and a block's last
    two matches, which may look at what follows, must be the same without what
    follows the block. A text that is a single match from some place on isn't cut
    there.
    """
    start, last = 0, [0, 0, 0]
    for found in matches.finditer(text):
        last = [*last[1:], found.end()]
        if last[2] - start < _BLOCK or last[2] == len(text):
            continue
        alone = (matches.match(text, begin, endpos=last[2]) for begin in last[:2])
        if [m and m.end() for m in alone] == last[1:]:
            yield last[2]
            start = last[2]
    yield len(text)


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of the whole text."""
    if len(text) <= _BLOCK:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for end in _ends(regex.compile(encoding._pat_str), text):
        ids += encoding.encode_ordinary(text[start:end])
        start = end
    return ids


def _rows(part: int, first: int, held, length: int, pad: int) -> Iterator[pa.RecordBatch]:
    """Pack segments ``(doc_id, offset, ids)`` and give the sequences in batches."""
    sequences = best_fit([len(ids) for _, _, ids in held], length)
    for start in range(0, len(sequences), _SENT):
        some = sequences[start : start + _SENT]
        matrix = np.full((len(some), length), pad, "<u2")
        cuts, docs, offsets = [], [], []
        for row, numbers in enumerate(some):
            ends = [0]
            for number in numbers:
                ids = held[number][2]
                matrix[row, ends[-1] : ends[-1] + len(ids)] = ids
                ends.append(ends[-1] + len(ids))
            cuts.append(ends)
            docs.append([held[n][0] for n in numbers])
            offsets.append([held[n][1] for n in numbers])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(some), pa.int32()),
                pa.array(range(first + start, first + start + len(some)), pa.int64()),
                pa.array([c[-1] for c in cuts], pa.int32()),
                pa.array([row.tobytes() for row in matrix], pa.binary()),
                pa.array(cuts, pa.list_(pa.int32())),
                pa.array([c[:-1] for c in cuts], pa.list_(pa.int32())),
                pa.array(docs, pa.list_(pa.int64())),
                pa.array(offsets, pa.list_(pa.int64())),
            ],
            ["part", "sequence", "n_tokens", "ids", "cumulative", "resets", "doc_ids", "offsets"],
        )


def _pack(shared, length: int, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, part = _encoding(shared), TaskContext.get().partitionId()
        held, tokens, first = [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.asarray([*encode(encoding, text.as_py() or ""), end_id], "<u2")
                for offset in range(0, len(ids), length):
                    held.append((doc_id, offset, ids[offset : offset + length]))
                tokens += len(ids)
                if tokens >= window:
                    done = first
                    for out in _rows(part, first, held, length, end_id):
                        done += out.num_rows
                        yield out
                    held, tokens, first = [], 0, done
        if held:
            yield from _rows(part, first, held, length, end_id)

    return run


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    length: int = LENGTH,
    window: int = WINDOW_TOKENS,
) -> DataFrame:
    """Sequences of ``length`` token ids: ``part, sequence, n_tokens, ids, cumulative, resets, doc_ids, offsets``.

    ``ids`` is a row of the id matrix, ``length`` little-endian 16-bit numbers;
    places from ``n_tokens`` on are padding. ``cumulative`` starts at 0 and ends
    at ``n_tokens``, with the summed lengths of the segments; ``resets`` has the
    places at which position numbers start again from 0. ``doc_ids`` and
    ``offsets`` tell each segment's document and its first id's place there.
    ``part`` and ``sequence`` number the rows.

    Every text ends with the id after the last rank, so a null or empty text is
    a segment of that id alone and no row is left out. Rows stay apart, also
    equal ones and those without doc_id; other columns aren't read; an empty
    table gives no rows. The same files in the same splits give the same rows.
    ``ranks_path`` is read on the driver only.
    """
    ranks = load_ranks(ranks_path)
    end_id = max(ranks.values()) + 1
    if end_id >= 1 << 16:
        raise ValueError("ids don't fit in 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    return ids_and_texts(docs).mapInArrow(
        _pack(shared, length, end_id, window),
        "part int, sequence long, n_tokens int, ids binary, cumulative array<int>, resets array<int>, "
        "doc_ids array<long>, offsets array<long>",
    )


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the id matrix and its segments, a file for each task; a task that is run again replaces its file."""
    packed.write.parquet(path)
