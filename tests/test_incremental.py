import os

from tenderflow.operators.keyed import BUCKET, merge_buckets, read_buckets
from tenderflow.streaming.ingest import ingest_stream

SCHEMA = "k long, v string, t long"


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v", "t").collect())


def merged(spark, path, batches, mode):
    for b in batches:
        merge_buckets(spark.createDataFrame(b, SCHEMA), path, ["k"], ["t"], mode, buckets=8)
    return rows(read_buckets(spark, path))


BATCHES = [[(i, "a", 1) for i in range(20)] + [(3, "b", 2)], [(3, "old", 0), (5, "c", 3), (30, "d", 1)], [], [(30, "e", 2), (30, "f", 1)]]


def test_both_modes_and_a_replay(spark, tmp_path):
    last, first = {}, {}
    for b in BATCHES:
        for k, v, t in b:
            last[k] = max(last.get(k, (-1, "")), (t, v))
        for k in {r[0] for r in b} - set(first):
            first[k] = min((t, v) for kk, v, t in b if kk == k)
    for mode, want in (("upsert", last), ("insert", first)):
        want = sorted((k, v, t) for k, (t, v) in want.items())
        path = str(tmp_path / mode)
        assert merged(spark, path, BATCHES, mode) == want
        assert merged(spark, path, BATCHES[:2] + BATCHES[1:], mode) == want


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    merged(spark, path, BATCHES[:1], "upsert")
    files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith(BUCKET)}
    before = files()
    merged(spark, path, [[(7, "z", 9)]], "upsert")
    after = files()
    assert sum(before[d] != after[d] for d in before) == 1 and set(before) == set(after) and len(before) > 1


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    want = {}
    for b in BATCHES:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        got = ingest_stream(spark, source, schema, target, ["k"], ["t"], name=str(tmp_path).replace("/", "-"))
        for k, v, t in b:
            want[k] = max(want.get(k, (-1, "")), (t, v))
        assert rows(got) == sorted((k, v, t) for k, (t, v) in want.items())
