import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderflow.llm import negatives as N


def brute(rows, k=5):
    """All anchors against all rows with Python integers."""
    live = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    live = {(i, (lab + 1) % 10 if i % 7 == 0 else lab, q) for i, lab, q in live}
    out = []
    for i, lab, q in live:
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, r)), j, m) for j, m, r in live if (j, m, r) != (i, lab, q) and len(r) == len(q)]
        for s, j, _ in sorted(t for t in scored if t[2] == lab)[:k]:
            fits = sorted(t for t in scored if t[2] != lab and 80 * -s <= 100 * -t[0] <= 100 * -s)[:k]
            out += [(i, j, r + 1, t[1], -s, -t[0]) for r, t in enumerate(fits)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "a") for r in rows], "vec_id long, embedding array<double>, label int, rank int, rid string")
    got = N.mine(N.relabelled(df), F.col("vec_id") % 100 == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    out = []
    for i in range(n):
        x = centres[i % 4] * rng.uniform(0, 1) + rng.standard_normal(dim) * spread
        out.append((i * 5, [float(v) for v in np.round(x / np.linalg.norm(x), 2)], int(rng.integers(0, 4))))
    return out


ODD = [(None, [1.0, 0.0], 1), (10_000, None, 1), (10_001, [1.0, None], 1), (10_002, [float("nan"), 1.0], 1), (10_003, [float("inf"), 1.0], 2),
       (10_004, [0.5, 0.5], None), (10_100, [0.0, 0.0], 1), (10_101, [0.5, 0.5], 1), (10_105, [0.25, 0.5], 2), (10_106, [0.25, 0.5], 3),
       (10_107, [], 1), (10_200, [], 1), (10_201, [], 2), (10_300, [1.0], 1), (10_301, [2.0], 1), (10_302, [1.9], 2), (10_302, [1.9], 2),
       (10_302, [1.8], 2), (10_303, [-1.0], 1), (10_400, [-1.0, 0.5], 2), (10_402, [-0.5, 0.5], 2), (10_404, [-0.45, 0.5], 1)]


@pytest.mark.parametrize("block,chunk", [(1 << 13, 1 << 12), (37, 3)])
def test_equals_brute_force(spark, block, chunk):
    rows = vectors(400, 12, 1, 0.3) + ODD
    assert run(spark, rows, block=block, chunk=chunk) == brute(rows)


def test_ties_and_one_hot_label(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(4)], 1 if rng.random() < .7 else rng.randint(2, 9)) for i in range(900)]
    assert run(spark, rows, block=100, chunk=4) == brute(rows)


def test_large_components_are_exact(spark):
    big = 2.0 ** 20
    rows = [(100, [big, big / 3], 1), (101, [big, 1.0], 1), (102, [big - 1, 0.1], 2), (103, [big * .9, 7.3], 2), (106, [-big, big], 3),
            (200, [2.0 ** 40, 0.0], 4), (201, [2.0 ** -8, 2.0 ** 900], 4), (202, [2.0 ** -8, 3.5], 5)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_no_anchor(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_search_stops_early_and_misses_nothing():
    rng = np.random.default_rng(3)
    q = np.floor(256 * np.concatenate([rng.standard_normal((3000, 8)) * 0.1, rng.standard_normal((50, 8)) * 2]))
    a, lists = q[3010], N.Lists(q)
    rows, s = lists.search(a, np.array([-np.inf]), np.array([np.inf]), 5, np.ones(len(q), dtype=bool))
    assert len(rows) < len(q) and sorted(s)[-5:] == sorted(q @ a)[-5:] and (s == q[rows] @ a).all()
    hi = np.sort(q @ a)[-20]
    rows, s = lists.search(a, np.array([0.8 * hi]), np.array([hi]), 5, np.ones(len(q), dtype=bool))
    inside = lambda v: np.sort(v[(v >= 0.8 * hi) & (v <= hi)])[-5:].tolist()
    assert len(rows) < len(q) and inside(s) == inside(q @ a)
