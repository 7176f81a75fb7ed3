"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from goldenlake.llm import variants as v
from goldenlake.llm.common import prepare

SCHEMA = "doc_id long, text string, word string, n long"


def near(a: str, b: str) -> bool:
    """One replaced, inserted or deleted code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs, delete: int, least: int) -> dict[str, int]:
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if delete and h % delete == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def brute(counts: dict[str, int], times: int = 10) -> dict[str, tuple]:
    forms, out = {}, {}
    for word, n in counts.items():
        others = [o for o in counts if near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        forms[word] = form
        out[word] = [form, None, n, len(others), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        row[1] = root
    return {word: tuple(row) for word, row in out.items()}


def got(frame) -> dict[str, tuple]:
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("plain", [64, 8, 0])
def test_words_against_all_pairs(spark, plain):
    prepare(spark)
    own = random.Random(2)
    counts = {}
    for _ in range(500):
        word = "".join(own.choices("abé", k=own.randint(5, 9)))
        counts[word] = own.choice([2, 3, 30, 40, 500, 500, 9000])
    for n, word in ((10**k, "zzzzzzz"[: 7 - k] + "y" * k) for k in range(1, 7)):
        counts[word] = n  # a long chain of forms
    counts |= {"m" * 70: 3, "m" * 71: 30, "m" * 69 + "n": 400, "×" * 7: 5, "÷" * 7: 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = brute(counts)
    assert got(v.group_words(words, v.Settings(plain=plain))) == want
    assert max(row[3] for row in want.values()) > 3 and any(row[0] for row in want.values())


def test_documents_against_brute_force(spark):
    prepare(spark)
    own = random.Random(3)
    vocabulary = ["".join(own.choices("abcdefgé", k=own.randint(4, 11))) for _ in range(40)] + ["MÜNCHEN", "Straße"]
    rows = []
    for i in range(200):
        text = own.choice([" ", ", ", "\n", "7"]).join(own.choices(vocabulary, k=60))
        rows.append((i, own.choice([text, text.upper(), text.title()]), "x", 1))
    rows += [(None, "nothing nothing", "x", 1), (7, None, None, None), (8, "", "x", 1), (9, " \n", "x", 1)]
    rows += [(10 + i, "q" * 3000 + " " + "q" * 2999, "x", 1) for i in (0, 0, 1, 2, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    settings = v.Settings(delete=5, held=50, slice=100)
    want = brute(brute_counts(rows, 5, 7))
    assert got(v.variants(docs, settings)) == want
    assert any(row[0] for row in want.values())


def test_nothing(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, None, None, None), (2, "once only", None, None)], SCHEMA)
    assert v.variants(docs).isEmpty() and v.variants(docs.limit(0)).isEmpty()
    assert v.variants(docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]
