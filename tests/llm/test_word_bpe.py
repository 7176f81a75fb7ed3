"""Ids of the word-level tokenizer against the library, on words made to collide and on very long ones; packing."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from goldenlake.llm import packing
from goldenlake.llm.common import byte_values, prepare, run_hashes
from goldenlake.llm.word_bpe import WordCoder

WORD = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(letters: str, doublings: int) -> str:
    a, b = letters
    for _ in range(doublings):
        a, b = a + b, b + a
    return a


@pytest.fixture(scope="module")
def words():
    return WordCoder(WORD)


def same(words, texts):
    got = words.encode(pa.array(texts, pa.string()))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == words.library.encode(text or "", add_special_tokens=False).ids, (text or "")[:60]


def test_colliding_words_get_their_own_ids(words):
    """Polynomial hashes modulo 2^64 can't tell these apart."""
    for doublings in (5, 7, 10, 11, 12):
        same(words, [thue_morse("ab", doublings), thue_morse("ba", doublings), f"x {thue_morse('ab', doublings)}! y"])


def test_equal_hashes_are_not_trusted(words, monkeypatch):
    from goldenlake.llm import word_bpe

    poor = WordCoder(WORD)
    monkeypatch.setattr(word_bpe, "run_hashes", lambda *x: run_hashes(*x) % np.uint64(3))
    same(poor, ["one two three four", "five six one", None, "", "one", "zebra crossing lamp two"])


@pytest.mark.parametrize("unit", ["a", "acgt", "=", "é", "0123456789abcdef"])
def test_very_long_words(words, unit):
    same(words, [unit * (200_000 // len(unit)), "plain text beside it", f"some {unit * 300} more"])


def test_a_million_letters(words):
    own = random.Random(1)
    same(words, ["".join(own.choices("acgt", k=1_000_000)), "the end"])


def test_random_texts(words):
    own = random.Random(2)
    parts = ["the", "The ", " ", "\n", "don't", "12", "é", "É", "!", "word", "_", "<|x|>", "日本", "\t", "'ll ", "x" * 300]
    same(words, ["".join(own.choices(parts, k=own.randint(0, 40))) for _ in range(400)])


def test_pieces_of_hashing_do_not_show(monkeypatch):
    from goldenlake.llm import common

    codes = np.frombuffer(("some words of text, " * 50).encode(), np.uint8)
    inside = codes != 32
    start = inside & np.append(True, ~inside[:-1])
    whole = run_hashes(codes, start, inside, byte_values(False))
    monkeypatch.setattr(common, "PIECE", 7)
    assert (run_hashes(codes, start, inside, byte_values(False)) == whole).all()


def test_a_piece_is_cut_only_when_no_sequence_has_room():
    own = random.Random(3)
    settings = packing.Settings(length=64)
    for _ in range(100):
        sizes = [own.choice([1, 5, 20, 40, 63, 64, 100]) for _ in range(own.randint(1, 60))]
        pieces = [packing.Piece(i, 0, np.arange(n), n) for i, n in enumerate(sizes)]
        full, left = packing.pack(pieces, settings)
        assert all(sum(len(p.ids) for p in s) == 64 for s in full) and sum(len(p.ids) for p in left) < 64
        seen = {}
        for p in [p for s in full for p in s] + left:
            seen.setdefault(p.doc, []).append((p.start, len(p.ids)))
        for i, n in enumerate(sizes):
            parts = sorted(seen[i])
            assert sum(x for _, x in parts) == n and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:]))
    # Ten sequences: nine hold a document of 60, the tenth is the only one with room for one of 30.
    sizes = [60] * 9 + [40, 30, 20, 10]
    full, left = packing.pack([packing.Piece(i, 0, np.arange(n), n) for i, n in enumerate(sizes)], settings)
    assert sum(p.doc == 9 for s in full for p in s) + sum(p.doc == 9 for p in left) == 1


def test_long_texts_are_packed_whole(spark):
    prepare(spark)
    rows = [(1, "word " * 30_000), (2, "x" + " " * 70_000 + "y"), (3, "a" * 100_000), (4, None), (None, "")]
    found = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), WORD).collect()
    library = WordCoder(WORD).library
    for doc_id, text in rows:
        own = sorted((r.start, bytes(r.tokens)) for r in found if r.doc_id == doc_id)
        ids = np.frombuffer(b"".join(t for _, t in own), "<u4").tolist()
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]
