"""Language filter: random letters and scripts that were not learned go, held-out documents stay."""

from __future__ import annotations

import os
import random

import pytest

from goldenlake.llm import langid
from goldenlake.llm.common import prepare, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
def test_filter_and_held_out_accuracy(spark):
    prepare(spark)
    docs = table(spark, SF_DIR, "documents")
    own = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    noise = ["".join(own.choices(letters, k=own.randint(20, 2000))) for _ in range(60)]
    noise += ["съешь же ещё этих мягких французских булок " * 5, "日本語の文章です。" * 20, "123 456 !!", "", None]
    extra = spark.createDataFrame([(10**6 + i, t, None, "noise", 0) for i, t in enumerate(noise)], docs.schema)
    kept = langid.keep_identified(docs.unionByName(extra))
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert sum(i >= 10**6 for i in ids) <= 1
    answers = {r.doc_id: r for r in langid.identify(docs).collect()}
    truth = [r for r in docs.filter("lang IS NOT NULL AND text RLIKE '[a-z]{3}'").collect() if answers[r.doc_id].held_out]
    assert sum(answers[r.doc_id].lang_pred == r.lang for r in truth) >= 0.97 * len(truth)
    clean = [r for r in truth if len(r.text) >= 100]
    assert sum(r.doc_id in ids for r in clean) >= 0.99 * len(clean)


def test_bundles_against_single_ngrams():
    """The blockwise sums are those of one n-gram after the other."""
    settings = langid.Settings(dims=64)
    letters = langid.letter_vectors(settings)
    texts = ["Das ist gut", "a", "", None, "x\0y z", "é" * 10]
    codes, row = langid.ngrams(texts, 3)
    got = langid.bundles(codes, row, len(texts), letters, 3)
    for i, text in enumerate(texts):
        clean = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
        symbols = [0, *(langid.symbol_table()[ord(c)] for c in clean), 0]
        want = sum(
            (
                (letters[a].astype(int).take(range(-2, 62)) * letters[b].astype(int).take(range(-1, 63)) * letters[c].astype(int))
                for a, b, c in zip(symbols, symbols[1:], symbols[2:])
            ),
            start=0 * letters[0].astype(int),
        )
        assert (got[i] == want).all() or not clean
