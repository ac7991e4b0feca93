import itertools
from collections import Counter

import numpy as np
import pandas as pd

from tenderflow.operators import tiles as T
from tenderflow.operators.ranges import running_total


def test_running_total_is_global(spark):
    rows = [(i % 3, i * 7 % 50, i) for i in range(50)]  # a hot key spread over ranges
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = {(r.k, r.o): r.before for r in running_total(df, ["k", "o"], df.v, "before").collect()}
    want, total = {}, 0
    for k, o, v in sorted(rows):
        want[k, o] = total
        total += v
    assert got == want
    assert sorted(r.n for r in running_total(df, ["k", "o"], out="n").collect()) == list(range(50))
    assert running_total(df.where("false"), ["k", "o"]).count() == 0


def test_every_pair_meets_in_one_tile(spark):
    rows = [(1, i) for i in range(11)] + [(2, 100), (2, 101), (3, 200)]
    df = spark.createDataFrame(rows, "k long, id long")
    tiles = {}
    for r in T.tiled(df, "k", "id", 3).collect():
        tiles.setdefault((r.k, r.ti, r.tj), []).append((r.id, r.blk))
    met = Counter()
    for (k, i, j), members in tiles.items():
        for (a, x), (b, y) in itertools.combinations(sorted(members), 2):
            if i == j or x != y:
                met[k, a, b] += 1
    want = {(1, a, b) for a, b in itertools.combinations(range(11), 2)} | {(2, 100, 101)}
    assert set(met) == want and set(met.values()) == {1}


def test_whole_groups_never_split():
    rng = np.random.default_rng(0)
    k = np.sort(rng.integers(0, 12, 200))
    df = pd.DataFrame({"k": k, "t": 0, "v": np.arange(200)})
    cuts = np.sort(rng.choice(200, 30))
    batches = [df.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 200])]
    out = list(T.whole_groups(iter(batches), ["k", "t"]))
    assert pd.concat(out).v.tolist() == list(range(200))
    assert max(Counter(x for b in out for x in set(b.k)).values()) == 1
    assert list(T.whole_groups(iter([]), ["k"])) == []
    assert T.segment_ids(df, ["k", "t"]).max() == len(set(k)) - 1
