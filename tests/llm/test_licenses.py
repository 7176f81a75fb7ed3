"""Notices as they stand in real files: wrapped, indented, commented; and words that only add up over a long text."""

from __future__ import annotations

import random
import re

import pytest

from goldenlake.llm import licenses
from goldenlake.llm.common import prepare

WRAPPED = {
    "bsd": "Copyright (c) X\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the\nfollowing",
    "mpl-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed",
    "mit-text": "# Permission is hereby granted, free of charge, to any person obtaining\n# a copy of this software and associated",
    "apache-2.0": '   Licensed under the Apache License,\n   Version 2.0 (the "License");',
    "gpl-3.0": "This work is licensed under the\nGNU General Public\nLicense version 3",
}


def brute(text: str) -> dict[str, float]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, step, found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low), licenses.block_step(licenses.NOTICES), {}
    for label, notice in licenses.NOTICES.items():
        own = set(licenses.notice_words(notice))
        best = max(len(own & set(words[i : i + 2 * step])) for i in range(0, max(len(words), 1), step))
        if best >= licenses.needed(len(own), licenses.THRESHOLD):
            found[label] = best / len(own)
    return found


@pytest.mark.parametrize("before", [0, 7, 18, 200])
def test_wrapped_notices_are_found(spark, before):
    prepare(spark)
    lead = " ".join(f"w{i}" for i in range(before))
    rows = [(i, f"{lead}\n{text}\n{lead}") for i, text in enumerate(WRAPPED.values())]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in enumerate(WRAPPED):
        assert label in got[i].labels.split(",")


def test_every_row_against_brute_force(spark):
    prepare(spark)
    own = random.Random(4)
    vocabulary = sorted({w for n in licenses.NOTICES.values() for w in licenses.notice_words(n)}) + ["é", "x1", "other"]
    texts = [own.choice([" ", "\n", ", "]).join(own.choices(vocabulary, k=own.randint(0, 150))) for _ in range(150)]
    for notice in licenses.NOTICES.values():
        words = notice.split()
        for _ in range(6):
            some = [w for w in words if own.random() > 0.08]
            texts.append(" ".join([*own.choices(vocabulary, k=own.randint(0, 60)), *some, *own.choices(["other"], k=30)]))
    texts += [None, "", "\n \n", notice, notice.upper() + "\n" + notice]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(texts)
    for r in got:
        found = brute(texts[r.doc_id])
        assert set(r.labels.split(",")) - {"", *licenses.BASE_PHRASES.values()} == set(found)
        assert r.score == (1.0 if r.n_base else max(found.values(), default=0.0))


def test_scattered_words_are_no_notice(spark):
    prepare(spark)
    words = licenses.notice_words(licenses.NOTICES["bsd"])
    text = (" " + "filler " * 40).join(words)
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.score) == ("", 0.0)
