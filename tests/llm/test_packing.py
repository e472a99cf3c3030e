"""Best fit against a plain search, and packed rows that give every text back."""

import random

import numpy as np
import public_tokenizers
import tiktoken

from txlab.llm.packing import RoomTree, best_fit, encode, load_ranks, pack, write_packed

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain(sizes, length):
    rooms, sequences = [], []
    for number in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = [k for k in range(len(rooms)) if rooms[k] >= sizes[number]]
        if not fits:
            rooms.append(length)
            sequences.append([])
            fits = [len(rooms) - 1]
        least = min(rooms[k] for k in fits)
        rooms[[k for k in fits if rooms[k] == least][-1]] -= 0
        at = next(k for k in reversed(fits) if rooms[k] == least)
        rooms[at] -= sizes[number]
        sequences[at].append(number)
    return sequences, rooms


def test_room_tree():
    rng = random.Random(1)
    tree, held = RoomTree(37), []
    for _ in range(2000):
        if held and rng.random() < 0.5:
            room = held.pop(rng.randrange(len(held)))
            tree.add(room, -1)
        else:
            held.append(rng.randint(0, 37))
            tree.add(held[-1], 1)
        need = rng.randint(0, 37)
        assert tree.least(need) == min((r for r in held if r >= need), default=-1)


def test_best_fit():
    rng = random.Random(2)
    for _ in range(60):
        length = rng.randint(1, 40)
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 60))]
        ours = best_fit(sizes, length)
        assert sorted(k for s in ours for k in s) == list(range(len(sizes)))
        assert all(sum(sizes[k] for k in s) <= length for s in ours)
        assert sorted(length - sum(sizes[k] for k in s) for s in ours) == sorted(plain(sizes, length)[1])


def unpacked(rows, length):
    """Every document's ids again, by document and offset."""
    parts = {}
    for row in rows:
        ids = np.frombuffer(row.ids, "<u2")
        assert len(ids) == length and row.cumulative[0] == 0 and row.cumulative[-1] == row.n_tokens <= length
        assert row.resets == row.cumulative[:-1]
        for k, (doc, offset) in enumerate(zip(row.doc_ids, row.offsets)):
            parts.setdefault(doc, {}).setdefault(offset, []).append(ids[row.cumulative[k] : row.cumulative[k + 1]].tolist())
    return parts


def test_round_trip(spark, sf_dir, table, tmp_path):
    ranks = load_ranks(PATH)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    path = str(tmp_path / "packed")
    write_packed(pack(docs, PATH, public_tokenizers.PATTERN, length=256, window=5_000), path)
    rows = spark.read.parquet(path).collect()
    parts = unpacked(rows, 256)
    assert parts.keys() == texts.keys()
    for doc, pieces in parts.items():
        ids = [i for offset in sorted(pieces) for i in pieces[offset][0]]
        assert sorted(pieces) == list(range(0, len(ids), 256)) and ids == [*encoding.encode_ordinary(texts[doc]), 50256]
        assert encoding.decode(ids[:-1]) == texts[doc]
    assert len({(r.part, r.sequence) for r in rows}) == len(rows)
    assert sum(r.n_tokens for r in rows) > 0.95 * 256 * len(rows)
    odd = table([(1, None), (2, ""), (None, "a b"), (4, "same"), (4, "same")])
    parts = unpacked(pack(odd, PATH, public_tokenizers.PATTERN).collect(), 2048)
    assert parts[1] == parts[2] == {0: [[50256]]} and len(parts[4][0]) == 2 and parts[None]
    assert pack(table([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_encoded_in_blocks(monkeypatch):
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})
    monkeypatch.setattr("txlab.llm.packing._BLOCK", 100)
    text = "some words, and more words " * 40
    assert encode(encoding, text) == encoding.encode_ordinary(text)
    assert encoding.decode(encode(encoding, "é" * 1000)) == "é" * 1000


def test_blocks_give_the_ids_of_the_whole_text(monkeypatch):
    """Lists without spaces, runs of blanks and line ends, and single long matches, cut at every size."""
    rng = random.Random(2)
    pieces = ["1,", "x;", "中文", "  ", "   ", "\n", "\n\n ", " a", "it's", "'", "!?", "é", "\t", "😀", "7" * 30, "ab" * 40, " " * 60]
    encoding = tiktoken.Encoding("r", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})
    for block in (1, 7, 50, 333):
        monkeypatch.setattr("txlab.llm.packing._BLOCK", block)
        for _ in range(150):
            text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 120)))
            assert encode(encoding, text) == encoding.encode_ordinary(text)
    monkeypatch.undo()
    text = ",".join(str(rng.randrange(10**6)) for _ in range(40_000))
    assert len(text) > 250_000 and encode(encoding, text) == encoding.encode_ordinary(text)
