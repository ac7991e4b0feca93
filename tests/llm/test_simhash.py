import random

import numpy as np
import xxhash

from tenderflow.llm import simhash as S


def plain_fingerprint(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    k = min(k, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return fp - (1 << 64) if fp >> 63 else fp


def brute(ids, fps, bits=3):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (1 << 64) - 1).count("1") <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def test_fingerprint_matches_definition():
    for t in (None, "", "  \n", "One", "One two", "a B c\td\x0be f", "ÄÖ é x Y z", "w " * 3000 + "end"):
        assert S.fingerprint(t) == plain_fingerprint(t)
    assert S.fingerprint("A b C") == S.fingerprint("a B c") != S.fingerprint("a b c")


def test_anchor_covering_is_complete(spark):
    """Every pair of halves at distance 1 or less meets at a home of the first."""
    rng = random.Random(7)
    rows = []
    for _ in range(200):
        x = rng.getrandbits(32)
        rows += [(x,), (x ^ 1 << rng.randrange(32),)]
    from pyspark.sql import functions as F
    got = [r.a for r in spark.createDataFrame(rows, "h long").select(S.anchors(F.col("h")).alias("a")).collect()]
    for a, b in zip(got[::2], got[1::2]):
        assert a[0] in b and b[0] in a
        assert len(a) == len(set(a)) in (2, 17)


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for f in fps[:10]:
        g = f
        for _ in range(12):  # chains of neighbours
            for b in rng.sample(range(64), rng.randint(0, 4)):
                g ^= 1 << b
            fps.append(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps] + [0, 0, 7]
    rng.shuffle(signed)
    df = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
    want = brute(list(range(len(signed))), signed)
    from tenderflow.operators.components import connected
    for block in (S.BLOCK, 3):  # with tiles of three rows the same links must come out
        root = {r.node: r.root for r in connected(S.links(df, block=block)).collect()}
        groups = {}
        for i, f in enumerate(signed):
            groups.setdefault(root.get(f, f), []).append(i)
        assert sorted(min(g) for g in groups.values()) == sorted(set(want))
        assert all(want[i] == min(g) for g in groups.values() for i in g)


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "A B C d e f g"), (5, "x " * 5000), (9, "\t")]
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(docs_of(rows)).collect()), key=str)
    fps = [plain_fingerprint(t) for _, t in rows]
    want = sorted(((i, f, c) for (i, _), f, c in zip(rows, fps, brute([i for i, _ in rows], fps))), key=str)
    assert got == want
    kept = S.keep_first_of_group(docs_of(rows), S.near_duplicates(docs_of(rows)))
    assert kept.columns == docs_of(rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "None"]
    assert S.near_duplicates(docs_of(rows).where("false")).count() == 0


def test_forest_spans_every_link():
    rng = np.random.default_rng(0)
    base = np.uint64(rng.integers(1 << 62))
    fp = np.unique(np.array([base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 64, (200, 2))]))
    u, v = S._forest(fp, np.ones(len(fp), bool), None, 3)
    ids = {f: i for i, f in enumerate(fp.tolist())}
    signed = fp.view(np.int64).tolist()
    want = brute(list(range(len(fp))), signed)
    root = list(range(len(fp)))
    for _ in range(len(u)):
        for a, b in zip(u.tolist(), v.tolist()):
            m = min(root[ids[a]], root[ids[b]])
            root[ids[a]] = root[ids[b]] = m
    assert root == want and len(u) < len(fp)
