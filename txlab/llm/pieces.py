"""SentencePiece (merge type) encoding through prefix tables, and decoding.

For each prefix of a chunk of text there is exactly one last token that its
encoding can end with. The table of these tokens is filled from left to right:
an automaton names the vocabulary entries that end at a place, and an entry is
the one if the prefix before it ends with a token that it is *compatible* with,
that is, if merging the two tokens' characters by rule never joins them across
their boundary. Ids are then recovered backwards from the last prefix. The
merge rule is the library's: the pair with the best-scored joint entry first,
the leftmost one among equals; a character of no entry becomes its bytes.

Texts are cut where no entry can reach across (before a run of spaces, around a
character of no longer entry), and ids of a short chunk are kept for its next use,
also by the worker's next task, in a bounded number of bytes.
The vocabulary is read once on the driver; it has a fixed size and is what is
broadcast.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlab.llm.common import held_in_worker, ids_and_texts, release

_SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NEVER = float("-inf")
#: Characters after which a long text is cut at the next place where it may be.
_BLOCK = 1_000_000
#: Bytes of the chunks whose ids a worker keeps, and the characters of such a chunk at most.
_KEPT_BYTES = 200_000_000
_KEPT_CHARACTERS = 64
#: Ids that an output batch holds at least before it is sent.
_BATCH_IDS = 500_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    unknown_surface: str


def load_vocabulary(path: str) -> Vocabulary:
    """Read a model file. Only merge-type models without text rewriting are taken."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm, train = model.normalizer_spec, model.trainer_spec
    if train.model_type != proto.TrainerSpec.BPE or not train.byte_fallback:
        raise ValueError("a merge-type model with byte fallback is needed")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("a model that rewrites texts is not supported")
    kinds = tuple(p.type for p in model.pieces)
    if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("user-defined and unused entries are not supported")
    return Vocabulary(
        tuple(p.piece for p in model.pieces),
        tuple(p.score for p in model.pieces),
        kinds,
        train.unk_surface,
    )


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("txlab-each-byte", _each_byte)


class _Kept(dict):
    """Values by key, in two generations.

    When the younger one weighs ``limit``, it becomes the older one, and what was
    not asked for since the last time is forgotten. Without ``weigh`` a value
    weighs 1; one that weighs nothing isn't kept.
    """

    def __init__(self, make, limit: int, weigh=None):
        super().__init__()
        self.make, self.limit, self.weigh = make, limit, weigh
        self.older, self.held = {}, 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        weight = 1 if self.weigh is None else self.weigh(key, value)
        if not weight:
            return value
        if self.held + weight > self.limit:
            self.older, self.held = dict(self), 0
            self.clear()
        self.held += weight
        self[key] = value
        return value


def _chunk_bytes(chunk: str, ids: bytes) -> int:
    """What a kept chunk takes, with its place in the table."""
    return sys.getsizeof(chunk) + sys.getsizeof(ids) + 100 if len(chunk) <= _KEPT_CHARACTERS else 0


class PieceCoder:
    """Encodes and decodes with one vocabulary. Tokens are ids; single characters of no
    entry get numbers from the vocabulary's size on."""

    def __init__(self, vocabulary: Vocabulary, kept_bytes: int = _KEPT_BYTES):
        self.names = list(vocabulary.pieces)
        self.size = len(self.names)
        self.width = self.size + 0x110000
        normal = [i for i, kind in enumerate(vocabulary.kinds) if kind == _NORMAL]
        self.ids = {self.names[i]: i for i in normal}
        self.scores = {self.names[i]: vocabulary.scores[i] for i in normal}
        self.byte_ids = {
            int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(self.names, vocabulary.kinds)) if kind == _BYTE
        }
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(self.names[i], (i, len(self.names[i])))
        self.automaton.make_automaton()
        self.merges = _Kept(self._merge, 100_000)
        self.compatible = _Kept(self._compatible, 300_000)
        self.chunks = _Kept(self._encode_chunk, kept_bytes // 2, _chunk_bytes)
        longer = [p for p in self.ids if len(p) > 1]
        inside = set("".join(longer))
        self.unlisted = inside - self.ids.keys()
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in longer)
        inner = re.escape("".join(sorted(inside - {_SPACE}))) or _SPACE
        self.split = re.compile(f"{_SPACE}*[{inner}]+|{_SPACE}+|[^{inner}{_SPACE}]").findall
        shown = []
        for piece, kind in zip(vocabulary.pieces, vocabulary.kinds):
            if kind == _BYTE:
                shown.append(bytes([int(piece[3:5], 16)]))
            elif kind == _CONTROL:
                shown.append(b"")
            elif kind == _UNKNOWN:
                shown.append(vocabulary.unknown_surface.encode())
            else:
                shown.append(piece.replace(_SPACE, " ").encode())
        self.shown = shown
        self.leading = [k == _NORMAL and p.startswith(_SPACE) for p, k in zip(vocabulary.pieces, vocabulary.kinds)]
        self.silent = {i for i, k in enumerate(vocabulary.kinds) if k == _CONTROL}

    def _name(self, token: int) -> str:
        return self.names[token] if token < self.size else chr(token - self.size)

    def _merge(self, token: int):
        """Steps of merging a piece's characters: score, first and last symbol after it.

        None for an entry that merging never arrives at.
        """
        symbols, steps = list(self._name(token)), []
        while len(symbols) > 1:
            best, at = _NEVER, -1
            for k in range(len(symbols) - 1):
                score = self.scores.get(symbols[k] + symbols[k + 1], _NEVER)
                if score > best:
                    best, at = score, k
            if at < 0:
                return None
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append((best, symbols[0], symbols[-1]))
        return steps

    def _compatible(self, pair: int) -> bool:
        """Whether merging both tokens' characters at once leaves the two tokens."""
        before, after = divmod(pair, self.width)
        left, right = self.merges[before], self.merges[after]
        if left is None or right is None:
            return False
        last, first, i, j = self._name(before)[-1], self._name(after)[0], 0, 0
        while True:
            next_left = left[i][0] if i < len(left) else _NEVER
            next_right = right[j][0] if j < len(right) else _NEVER
            across = self.scores.get(last + first, _NEVER)
            if across > next_left and across >= next_right and across != _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left >= next_right:
                last, i = left[i][2], i + 1
            else:
                first, j = right[j][1], j + 1

    def _last_tokens(self, chunk: str) -> list[int]:
        """For each prefix the last token of its encoding."""
        compatible, width = self.compatible, self.width
        last = [-1] * (len(chunk) + 1)
        for end, (token, length) in self.automaton.iter(chunk):
            end += 1
            if last[end] < 0:
                start = end - length
                if compatible[last[start] * width + token] if start else self.merges[token] is not None:
                    last[end] = token
        return last

    def _last_tokens_unlisted(self, chunk: str) -> list[int]:
        """The same where a character may be no entry and so end with itself."""
        ending: list[list[tuple[int, int]]] = [[] for _ in chunk]
        for end, entry in self.automaton.iter(chunk):
            ending[end].append(entry)
        last = [-1]
        for end, char in enumerate(chunk, 1):
            own = [] if char in self.ids else [(self.size + ord(char), 1)]
            last.append(
                next(
                    token
                    for token, length in ending[end - 1] + own
                    if (self.compatible[last[end - length] * self.width + token] if end > length else self.merges[token] is not None)
                )
            )
        return last

    def _encode_chunk(self, chunk: str) -> bytes:
        n = len(chunk)
        listed = chunk in self.ids if n == 1 else not self.unlisted or self.unlisted.isdisjoint(chunk)
        last = self._last_tokens(chunk) if listed and self.cuts else self._last_tokens_unlisted(chunk)
        ids: list[int] = []
        while n:
            token = last[n]
            if token < self.size:
                ids.append(token)
                n -= len(self.names[token])
            else:
                ids.extend(self.byte_ids[b] for b in reversed(chr(token - self.size).encode()))
                n -= 1
        ids.reverse()
        return array("i", ids).tobytes()

    def _blocks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > _BLOCK and self.cuts:
            cut = text.find(_SPACE, start + _BLOCK)
            while cut > 0 and text[cut - 1] == _SPACE:
                cut -= 1
            if cut <= start:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def encode(self, text: str) -> array:
        ids = array("i")
        if text:
            for block in self._blocks(_SPACE + text.replace(" ", _SPACE)):
                chunks = self.split(block) if self.cuts else [block]
                ids.frombytes(b"".join(map(self.chunks.__getitem__, chunks)))
        return ids

    def decode(self, ids) -> bytes:
        """UTF-8 bytes of the text; bytes that don't form characters become U+FFFD each."""
        if self.silent.isdisjoint(ids):
            return self._shown(ids, True)
        # A control entry shows nothing, but bytes on its two sides form no character.
        out, start = b"", 0
        for end in [*(k for k, i in enumerate(ids) if i in self.silent), len(ids)]:
            out += self._shown(ids[start:end], not out)
            start = end + 1
        return out

    def _shown(self, ids, first: bool) -> bytes:
        out = b"".join(map(self.shown.__getitem__, ids))
        if first and len(ids) and self.leading[ids[0]]:
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode("utf-8", "txlab-each-byte").encode()
        return out


def coder_of(shared) -> PieceCoder:
    """The worker's coder of a broadcast vocabulary."""
    return held_in_worker(("pieces", hash(shared.value)), lambda: PieceCoder(shared.value))


def id_lists(rows: list[array]) -> pa.ListArray:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.frombuffer(b"".join(row.tobytes() for row in rows), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _round_trip(shared, keep: bool):
    def coded(coder: PieceCoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc_ids, texts = batch.column("doc_id"), batch.column("text")
        start, held, rows, shown = 0, 0, [], []
        for k in range(batch.num_rows):
            ids = coder.encode(texts[k].as_py() or "")
            rows.append(ids)
            shown.append(coder.decode(ids))
            held += len(ids)
            if held >= _BATCH_IDS or k + 1 == batch.num_rows:
                decoded = pa.array(shown, pa.binary()).cast(pa.string())
                columns = [doc_ids.slice(start, len(rows)), id_lists(rows), decoded]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])
                start, held, rows, shown = k + 1, 0, [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared)
        for batch in batches:
            yield from coded(coder, batch)
        if not keep:
            del coder
            release()

    return run


def encode_and_decode(docs: DataFrame, model_path: str, keep: bool = True) -> DataFrame:
    """``doc_id, ids, decoded`` of each row: a text's ids and the text they decode to.

    Ids are those of the library's ``encode`` without begin and end ids and
    without sampling, the text is that of its ``decode``. A null or empty text
    has no ids and decodes to an empty text. Rows stay apart, also equal ones
    and those without doc_id; other columns are left out. An empty table gives
    no rows. ``model_path`` is read on the driver only. Workers keep tables and
    chunks for their next task, up to about 300 MB, unless ``keep`` is false.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_path))
    return ids_and_texts(docs).mapInArrow(
        _round_trip(shared, keep), "doc_id long, ids array<int>, decoded string"
    )


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared)
        for batch in batches:
            texts = [None if ids is None else coder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"]
            )

    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model_path))
    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(
        _decode(shared), "doc_id long, text string"
    )
