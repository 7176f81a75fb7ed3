"""What the operators share: memory of Python workers, shingles."""

from __future__ import annotations

import os
import resource

import numpy as np
import pyarrow as pa
import pytest

from goldenlake.llm import common


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * resource.getpagesize()


def test_freed_memory_goes_back():
    kept, rest = [], []
    for i in range(300_000):
        (kept if i % 1000 == 0 else rest).append(bytes(1000))
    full = resident()
    rest.clear()
    common.give_back()
    assert full - resident() > 150e6


@pytest.mark.parametrize("fails", [False, True])
def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch, fails):
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append("back"))

    class Frame:
        def mapInArrow(self, run, schema):
            return run(iter([1, 2]))

    def run(batches):
        for x in batches:
            if fails and x == 2:
                raise ValueError
            yield x

    out = common.mapped(Frame(), run, "x long")
    assert next(out) == 1 and not told
    if fails:
        with pytest.raises(ValueError):
            next(out)
    else:
        assert list(out) == [2]
    assert told == ["back"]


def test_shingles_of_short_rows():
    words, offsets = np.arange(10, 17, dtype=np.uint64), np.array([0, 0, 2, 7, 7])
    values, bounds = common.shingles(words, offsets, 5)
    assert bounds.tolist() == [0, 0, 1, 2, 2]
    for value, row in zip(values, ([10, 11, 3, 4, 5], [12, 13, 14, 15, 16]), strict=True):
        want = np.zeros(1, np.uint64)
        for x in row:
            want = common.mix(want + np.uint64(x))
        assert value == want[0]


def test_words_hashed_by_place_are_those_hashed_by_run():
    """Rows without words, words around the limit of places, bytes of two classes."""
    rows = ["", None, " a  bc\t", "é" * 31 + " x", "w" * 63 + " " + "W" * 64 + " " + "w" * 65 + "1" + "w" * 200, " ", "last 9one9"]
    column = pa.array(rows, pa.string())
    for classes in (common.SHINGLE_WORDS, common.byte_classes(" \t", "19")):
        for lower in (True, False):
            data, offsets = common.text_bytes(column)
            kind = classes[data]
            start = common.word_starts(kind, offsets)
            got, bounds = common.word_hashes(column, classes, lower)
            assert (got == common.run_hashes(data, start, kind > 0, common.byte_values(lower))).all()
            assert (bounds == np.searchsorted(np.flatnonzero(start), offsets)).all()


def test_words_are_hashed_without_their_runs(monkeypatch):
    """Short words, nearly all of them, do not take the dearer way by whole runs of bytes."""
    monkeypatch.setattr(common, "run_hashes", None)
    got, _ = common.word_hashes(pa.array(["some short words", None, "short"]), common.SHINGLE_WORDS)
    assert len(got) == 4 and got[1] == got[3]
