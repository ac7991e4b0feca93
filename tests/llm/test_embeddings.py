import math

import numpy as np

from tenderflow.llm import embeddings as E


def brute(rows, threshold=0.98):
    def fine(r):
        return (r[0] is not None and r[1] and r[2] is not None and all(v is not None and math.isfinite(v) for v in r[1])
                and any(r[1]))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = [0] * len(rows)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if fine(a) and fine(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v, float) / np.abs(v).max() for v in (a[1], b[1]))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], low.get(find(i)), r[0] is not None and low.get(find(i)) == r[0])
                   for i, r in enumerate(rows)), key=str)


def data():
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for label in (1, 2):
        for _ in range(25):
            c = rng.standard_normal(32)
            for _ in range(rng.integers(1, 12)):
                # cosines around the threshold
                x = (c + rng.standard_normal(32) * rng.choice([0, .05, .1, .15])).astype(np.float32) * rng.uniform(.5, 2)
                rows.append((n, [float(v) for v in np.float32(x)], label))
                n += 1
    first = rows[0][1]
    rows += [(n, list(first), 1), (n + 1, list(first), 2), (n + 2, list(first), None), (n + 3, None, 1), (n + 4, [0.0] * 32, 1),
             (n + 5, [float("nan")] + first[1:], 1), (n + 6, [float("inf")] + first[1:], 1), (n + 7, [None] + first[1:], 1),
             (None, list(first), 1), (n + 8, [], 1), (n + 9, first[:16], 1), (n + 10, first[:16], 1), rows[3], rows[3]]
    return rows


def test_links_equal_brute_force(spark):
    rows = data()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "0 as n_links", "1 as kept")
    for block in (E.BLOCK, 4):
        got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df, block=block).collect()), key=str)
        assert got == brute(rows)


def test_large_and_small_finite_vectors_link(spark):
    rows = [(1, [1e200, 2e200], 1), (2, [2e200, 4e200], 1), (3, [1e-200, 2e-200], 1), (4, [2e200, -1e200], 1), (5, [5e-324, 1e-323], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df).collect()} == \
        {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    d, wide, n, t = 48, 128, 4000, 0.98
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    o = rng.standard_normal((n, d))
    o -= (o * x).sum(1, keepdims=True) * x
    y = t * x + math.sqrt(1 - t * t) * o / np.linalg.norm(o, axis=1, keepdims=True)
    (cx, fx), (cy, fy) = E.encode(x, wide), E.encode(y, wide)
    (xa, xb), (ya, yb) = E.reconstruct(cx, fx, d, wide), E.reconstruct(cy, fy, d, wide)
    est = ((xa * yb).sum(1) + (xb * ya).sum(1)) / 2
    assert abs(est.mean() - t) < 0.003
    one = (t - E.lower_limit(fx, fy, d, wide, t, 1.0)).mean()
    assert 0.7 < est.std() / one < 1.3
    assert (est >= E.lower_limit(fx, fy, d, wide, t, E.SIGMAS)).mean() > 0.999


def test_recall_formula():
    for n in (10, 10_000, 10 ** 9):
        bits, bands = E.plan(n)
        assert 1 - (1 - (1 - math.acos(.98) / math.pi) ** bits) ** bands >= E.RECALL


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(df).count() == 0
