import pytest
import datetime as dt

from pyspark.sql import functions as F

from tenderflow.operators import currency as CU
from tenderflow.operators import keyed as K


def rates(spark):
    return spark.createDataFrame([("BGN", dt.date(2020, 1, 15), 1.9558), ("BGN", dt.date(2020, 2, 1), 1.96)],
                                 "currency string, day date, rate double")


def test_convert_dated(spark):
    df = spark.createDataFrame([(100.0, "EUR", "BGN", dt.date(1976, 1, 1)), (100.0, "EUR", "XYZ", dt.date(2020, 1, 15)),
                                (100.0, "EUR", "BGN", dt.date(2020, 1, 15))], "a double, c string, to string, d date")
    got = []
    for r in df.collect():
        one = spark.createDataFrame([r], df.schema)
        got.append(CU.convert(one, "a", "c", rates(spark), "out", to=r.to, day="d").first().out)
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] > 0


def test_convert_last_and_bounds(spark):
    df = spark.createDataFrame([(19.6, "BGN"), (None, "EUR"), (5.0, "XYZ")], "a double, c string")
    out = [r.out for r in CU.convert(df, "a", "c", rates(spark), "out").collect()]
    assert abs(out[0] - 10.0) < 1e-9 and out[1] == 0.0 and out[2] == 0.0
    b = CU.rate_bounds(rates(spark)).first()
    assert b.first_day == dt.date(2020, 1, 15) and b.last_day == dt.date(2020, 2, 1)


def test_keep_first_last_and_checks(spark):
    df = spark.createDataFrame([(1, 1, "b", 2), (1, 1, "a", 9), (2, 1, "c", 1)], "k1 int, k2 int, v string, o int")
    first = {(r.k1, r.k2): r.v for r in K.keep_first(df, ["k1", "k2"], ["v"]).collect()}
    last = {(r.k1, r.k2): r.v for r in K.keep_last(df, ["k1", "k2"], ["o"]).collect()}
    assert first == {(1, 1): "a", (2, 1): "c"} and last == {(1, 1): "a", (2, 1): "c"}
    assert [tuple(r) for r in K.pk_violations(df, ["k1", "k2"]).collect()] == [(1, 1, 2)]
    parent = spark.createDataFrame([(1,)], "k1 int")
    assert K.fk_orphans(df, ["k1"], parent, ["k1"]).count() == 1


def test_insert_if_absent_and_upsert_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1)], "k int, v string, ts int")
    new = spark.createDataFrame([(1, "b", 2), (2, "c", 2)], "k int, v string, ts int")
    ins = K.insert_if_absent(old, new, ["k"])
    assert sorted(map(tuple, ins.collect())) == [(1, "a", 1), (2, "c", 2)]
    up1 = K.upsert(old, new, ["k"], ["ts"])
    up2 = K.upsert(up1, new, ["k"], ["ts"])
    assert sorted(map(tuple, up1.collect())) == sorted(map(tuple, up2.collect())) == [(1, "b", 2), (2, "c", 2)]


def test_load_keyed_and_upsert_path(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    K.load_keyed(df, path, ["k"])
    try:
        K.load_keyed(df, path, ["k"])
        raise AssertionError("duplicate keys must fail")
    except ValueError:
        pass
    K.load_keyed(spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string"), path, ["k"], mode="skip")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_checked_load(spark, tmp_path):
    parent, child = str(tmp_path / "p"), str(tmp_path / "c")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert K.load_checked(df, parent, "k", {}) == {"rows": 2, "repeated": 0, "null_keys": 0}
    kids = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 2)], "id int, k int")
    assert K.load_checked(kids, child, "id", {"k": (parent, "k")}, mode="report") == \
        {"rows": 4, "repeated": 0, "null_keys": 0, "filled k": 3, "orphans k": 1}
    assert spark.read.parquet(child).columns == ["id", "k"] and spark.read.parquet(child).count() == 4
    with pytest.raises(ValueError, match="orphans k"):
        K.load_checked(kids, str(tmp_path / "f"), "id", {"k": (parent, "k")})
    with pytest.raises(ValueError, match="repeated"):
        K.load_checked(df.unionByName(df.withColumn("v", df.k.cast("string"))), str(tmp_path / "r"), "k", {})
    with pytest.raises(ValueError, match="no rows"):
        K.load_checked(df.where("false"), str(tmp_path / "e"), "k", {})
