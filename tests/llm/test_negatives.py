"""Hard negatives against all scores, and the bounds that spare most of them."""

from __future__ import annotations

import numpy as np
import pytest

from goldenlake.llm import negatives as m
from goldenlake.llm.common import prepare

SCHEMA = "vec_id long, label int, embedding array<float>, norm string, part int"


def brute(rows, s: m.Settings) -> set[tuple]:
    """Of repeated ids the smallest by label and vector; everything in Python integers."""
    known = {}
    for vec_id, label, vector, *_ in rows:
        if vec_id is None or label is None or not vector:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = (label, [float(np.float32(x)) for x in vector])
        known[vec_id] = min(known.get(vec_id, row), row)
    whole = {i: (label, [int(np.floor(s.scale * x)) for x in v]) for i, (label, v) in known.items()}

    def score(a, b):
        return sum(x * y for x, y in zip(whole[a][1], whole[b][1], strict=True))

    out = set()
    for a in (i for i in whole if i % s.every == 0):
        others = [i for i in whole if i != a and len(whole[i][1]) == len(whole[a][1])]
        ranked = sorted(((-score(a, i), i) for i in others))
        for minus, p in [x for x in ranked if whole[x[1]][0] == whole[a][0]][: s.positives]:
            fits = [x for x in ranked if whole[x[1]][0] != whole[a][0] and s.low * -minus <= 100 * -x[0] <= s.high * -minus]
            out |= {(a, p, rank, i, -minus, -n) for rank, (n, i) in enumerate(fits[: s.negatives], 1)}
    return out


def clustered(seed: int, n: int, dims: int, groups: int = 6):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((groups, dims))
    rows = []
    for i in range(n):
        v = centres[random.integers(groups)] + 0.5 * random.standard_normal(dims)
        rows.append((i, int(random.integers(0, 3)), [float(x) for x in v / np.linalg.norm(v) * random.choice([1.0, 1.0, 3.0])], "x", 1))
    return rows


ODD = [
    (None, 1, [1.0] * 8, None, 1),
    (10_000, None, [1.0] * 8, None, 1),
    (10_001, 1, None, None, 1),
    (10_010, 1, [], None, 1),
    (10_002, 1, [1.0, None] * 4, None, 1),
    (10_003, 1, [float("nan")] * 8, None, 1),
    (10_004, 1, [float("inf")] * 8, None, 1),
    (10_020, 1, [0.0] * 8, None, 1),
    (10_021, 1, [0.0] * 8, None, 1),
    (10_022, 2, [0.0] * 8, None, 1),
    (10_030, 1, [1.0, 2.0], None, 1),
    (10_031, 1, [2.0, 2.0], None, 1),
    (10_032, 2, [2.0, 1.5], None, 1),
]


@pytest.mark.parametrize("shard, block", [(2048, 256), (40, 7)])
def test_against_all_scores(spark, shard, block):
    prepare(spark)
    s = m.Settings(every=10, shard=shard, block=block)
    rows = clustered(1, 600, 8)
    copies = [(1000 + i, i % 3, rows[20][2], "x", 1) for i in range(300)]  # ties and a hot vector
    repeated = [(5, 2, rows[6][2], "x", 1), (5, 2, rows[6][2], "x", 1), (40, 0, rows[7][2], "y", 2)]
    data = rows + copies + repeated + ODD
    got = [tuple(r) for r in m.mine(spark.createDataFrame(data, SCHEMA).repartition(3), s).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(data, s) and len(got) > 500


def test_large_numbers(spark):
    prepare(spark)
    s = m.Settings(every=1, references=2)
    rows = [(i, i % 2, [float(np.float32(x * 3e5)) for x in row[2]], "x", 1) for i, row in enumerate(clustered(3, 20, 8))]
    assert {tuple(r) for r in m.mine(spark.createDataFrame(rows, SCHEMA), s).collect()} == brute(rows, s)


def test_bounds_hold_and_spare_work():
    rows = np.floor(np.array([r[2] for r in clustered(2, 900, 16)]) * 256)
    directions = m._directions(rows, m.Settings())
    norms = np.linalg.norm(rows, axis=1)
    angles = np.arccos(np.clip(rows / norms[:, None] @ directions.T, -1, 1))
    low, high = m.score_bounds(angles, angles, norms, norms)
    scores = rows @ rows.T
    assert (low <= scores).all() and (scores <= high).all()
    best = np.sort(scores, axis=1)[:, -6]
    assert (high >= best[:, None]).mean() < 0.5


def test_nothing(spark):
    prepare(spark)
    docs = spark.createDataFrame(ODD[:7], SCHEMA)
    assert m.mine(docs).isEmpty() and m.mine(docs.limit(0)).isEmpty()
    only = spark.createDataFrame([(0, 1, [1.0], None, 1), (1, 1, [1.0], None, 1)], SCHEMA)  # no other label
    assert m.mine(only).isEmpty()
