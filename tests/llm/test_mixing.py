import re
from collections import Counter, defaultdict

import pytest

from tenderflow.llm import mixing as M


def water_fill(sizes, weights, epochs=3):
    """Targets by raising a common level until all words are shared."""
    total, open_ = sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    left = float(total)
    while open_:
        rate = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if epochs * sizes[i] < weights[i] * rate}
        if not over:
            for i in open_:
                out[i] = weights[i] * rate
            break
        for i in over:
            out[i] = float(epochs * sizes[i])
            left -= out[i]
        open_ -= over
    return out


def highest_quotients(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[k] += 1
    return got


ROWS = [(i, "w " * (i % 7 * 40 + 5), s) for i, s in enumerate(["big"] * 60 + ["a"] * 5 + ["Z"] * 9 + ["é"] * 4)] \
    + [(100, None, "a"), (101, "", None), (102, "x y z", None), (None, "n " * 30, "big"), (7, "w " * 5, "big")]


def test_targets_quotas_and_taken(docs_of):
    out, quota = M.mix(docs_of(ROWS), block=8, shard_blocks=16)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    sizes = defaultdict(int)
    for _, t, s in ROWS:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, water_fill([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        assert r.taken == r.epochs_whole * r["size"] + sum(p.end - p.start for p in r.taken_words)
        assert all(0 <= p.start < p.end <= r["size"] for p in r.taken_words)
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= 4
    q = quota.collect()
    shards = sorted({r.shard for r in q})
    votes = [want[s] for s in order]
    for k in shards:  # the quotas up to any shard are what the highest quotients give
        upto = Counter()
        for r in q:
            if r.shard <= k:
                upto[r.source] += r.blocks
        assert [upto[s] for s in order] == highest_quotients(votes, sum(upto.values()))


def test_reruns_agree_and_rows_need_no_order(docs_of):
    a = sorted(map(str, M.mix(docs_of(ROWS), block=8)[0].collect()))
    b = sorted(map(str, M.mix(docs_of(ROWS[::-1]).repartition(5), block=8)[0].collect()))
    assert a == b


def test_capped_sources_share_their_excess(docs_of):
    rows = [(1, "a " * 10, "a"), (2, "b " * 10, "b"), (3, "c " * 1000, "c"), (4, "d " * 1000, "d")]
    t = {r.source: r.target for r in M.mix(docs_of(rows))[0].collect()}
    want = water_fill([10, 10, 1000, 1000], [1, 2, 3, 1])
    assert [t[s] for s in "abcd"] == pytest.approx(want) and t["a"] == 30 and t["b"] == 30


def test_empty_tables(docs_of):
    assert M.mix(docs_of(ROWS).where("false"))[0].count() == 0
    only = M.mix(docs_of([(1, None), (2, "")]))[0].collect()
    assert [(r["size"], r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


def test_seats_of_a_hot_source_are_made_in_bounded_rows(spark):
    from pyspark.sql import functions as F
    src = spark.createDataFrame([("hot", float(64 * 2 ** 33)), ("a", 640.0), (None, 6400.0), ("none", 1.0)], "source string, target double")
    by = {r.source: r for r in M.seat_rows(src, per_row=2 ** 28).withColumn("p", F.spark_partition_id()).groupBy("source").agg(
        F.min("first").alias("lo"), F.max("last").alias("hi"), F.sum(F.expr("last - first + 1")).alias("n"),
        F.max(F.expr("last - first + 1")).alias("most"), F.count_distinct("p").alias("tasks")).collect()}
    assert {k: (r.lo, r.hi, r.n) for k, r in by.items()} == {"hot": (0, 2 ** 33 - 1, 2 ** 33), "a": (0, 9, 10), None: (0, 99, 100)}
    assert by["hot"].most <= 2 ** 28 and by["hot"].tasks > 5
    # several rows of a source give the same seats as one
    some = spark.createDataFrame([("x", 250_001.0), ("y", 7.0)], "source string, target double")
    got = M.quotas(some, block=1, shard_blocks=10 ** 9).collect()
    assert {(r.source, r.blocks, r.first_seat) for r in got} == {("x", 250_001, 0), ("y", 7, 0)}
    assert M.seats(some, block=1).select("k").distinct().count() == 250_001


def test_quotas_count_seats_without_making_them(spark):
    from pyspark.sql import functions as F
    hot = spark.createDataFrame([("hot", 2_000_000.3), ("a", 640.0), (None, 90_400.0), ("none", 0.4), ("b", 640.0)], "source string, target double")
    many = spark.createDataFrame([(f"s{i}", 1.7 ** (i % 23)) for i in range(120)] + [(None, 777.7)], "source string, target double")
    for src, block, shard_blocks in ((hot, 1, M.SHARD_BLOCKS), (many, 2, 100), (many, 2, 10 ** 9)):
        seats = M.seats(src, block, shard_blocks).groupBy("shard", "source").agg(F.count("*").alias("blocks"), F.min("k").alias("first_seat"))
        want = sorted(map(str, seats.collect()))
        assert want and want == sorted(map(str, M.quotas(src, block, shard_blocks).collect()))
    # a row for each cell and source, not for each seat
    ranges = M.seat_ranges(hot, 1).agg(F.count("*"), F.sum(F.expr("last - first + 1")), F.max(F.expr("last - first"))).first()
    assert ranges[0] < 20_000 and ranges[1] == 2_000_000 + 640 + 90_400 + 640 and ranges[2] < 1000
