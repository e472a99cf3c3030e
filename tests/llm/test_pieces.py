"""Ids and texts equal the library's, on real, odd and random texts."""

import random

import public_tokenizers
import pytest
import sentencepiece

from txlab.llm.pieces import PieceCoder, decode, encode_and_decode, load_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(load_vocabulary(PATH))


def same(coder, text):
    ids = LIBRARY.encode(text)
    assert list(coder.encode(text)) == ids
    assert coder.decode(ids).decode() == LIBRARY.decode(ids)


def test_odd_texts(coder):
    for text in ["", " ", "   ", "\n", "a  b", "▁", "a▁b ▁", "\x00", "<s></s>", "<0x0A>", "😀é中", "x" * 3000, " " * 500]:
        same(coder, text)
    for n in range(1, 60):
        same(coder, "a" * n)


def test_random_texts(coder):
    rng = random.Random(4)
    parts = [LIBRARY.id_to_piece(i) for i in range(259, 32_000)]
    alphabet = ["a", "b", " ", "  ", "\n", "é", "▁", "😀", "中", "\t", "0", "ing", "tion", "ß", "न्", "​"]
    for _ in range(3000):
        same(coder, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))))
        same(coder, "".join(rng.choice(parts) for _ in range(rng.randint(1, 8))))
        same(coder, "".join(chr(rng.randint(0x20, 0x2FF)) for _ in range(rng.randint(1, 20))))


def test_any_ids_decode(coder):
    rng = random.Random(5)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))]
        assert coder.decode(ids).decode() == LIBRARY.decode(ids)


def test_forgetting_chunks_changes_nothing():
    small = PieceCoder(load_vocabulary(PATH), kept_bytes=900)
    for _ in range(3):
        same(small, "one two three one two three four five one six seven one")
    assert 0 < len(small.chunks) + len(small.chunks.older) <= 9


def test_kept_chunks_are_bounded_in_bytes(coder):
    """Hot chunks stay over many rare ones; texts without spaces are single chunks and aren't kept."""
    rng = random.Random(6)
    small = PieceCoder(load_vocabulary(PATH), kept_bytes=200_000)
    made, small.chunks.make = [], lambda chunk: made.append(chunk) or small._encode_chunk(chunk)
    for k in range(3000):
        small.encode("hot words " + "".join(rng.choice("abcdefgh") for _ in range(12)))
        assert small.chunks.held <= 100_000
    assert made.count("▁hot") == 1 and len(made) > 2900
    held = coder.chunks.held
    for _ in range(200):
        coder.encode("".join(rng.choice("abcdefgh") for _ in range(10_000)))
    assert coder.chunks.held == held


def test_long_text_is_cut_between_words(coder, monkeypatch):
    monkeypatch.setattr("txlab.llm.pieces._BLOCK", 50)
    same(coder, "some  words and\nlines " * 30 + "y" * 200)


def test_tables(spark, sf_dir, table):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    coded = encode_and_decode(docs, PATH)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in coded.collect():
        ids = LIBRARY.encode(texts[row.doc_id])
        assert row.ids == ids
        assert row.decoded == LIBRARY.decode(ids)
    odd = table([(1, None), (1, None), (2, ""), (None, "a b"), (3, "a b")])
    rows = sorted(((r.doc_id or 0, r.ids, r.decoded) for r in encode_and_decode(odd, PATH).collect()))
    assert rows == [(0, LIBRARY.encode("a b"), "a b"), (1, [], ""), (1, [], ""), (2, [], ""), (3, LIBRARY.encode("a b"), "a b")]
    assert encode_and_decode(table([]), PATH).count() == 0
    back = spark.createDataFrame([(1, [1, 450, 2]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [(r.doc_id, r.text) for r in decode(back, PATH).collect()] == [(1, LIBRARY.decode([1, 450, 2])), (2, None), (3, "")]
