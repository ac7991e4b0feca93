import datetime as dt

from pyspark.sql import functions as F

from tenderflow.functions import columns as C


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col(F.col("x")).alias("y")).first()[0]


def test_notice_link_and_parts(spark):
    iri = "epd:id_2015-S-250-456405_Notice"
    assert one(spark, C.notice_link, iri).endswith("NOTICE:456405-2015:TEXT:EN:HTML")
    assert one(spark, C.notice_year, iri) == "2015"
    assert one(spark, C.notice_number, iri) == "456405"
    assert one(spark, C.notice_link, "malformed") is None
    assert one(spark, C.notice_link, None) is None


def test_nuts_prefixes(spark):
    got = [one(spark, lambda c, n=n: C.prefix_level(c, n), "FRK26") for n in range(5)]
    assert got == ["FR", "FRK", "FRK2", "FRK26", None]
    arr = spark.createDataFrame([(["FRK26", None, "BE3"],)], "a array<string>") \
        .select(C.prefix_level_list("a", 1).alias("y")).first()[0]
    assert arr == ["FRK", None, "BE3"]


def test_local_name_segments_strip_split(spark):
    assert one(spark, C.local_name, "http://a/b#Lot_1") == "Lot_1"
    assert one(spark, C.local_name, "http://a/b/c") == "c"
    assert one(spark, C.last_segment, "http://a/b/c") == "c"
    assert one(spark, C.strip, " \t x y \n") == "x y"
    assert one(spark, C.split_list, "a ||| b|c ||| d") == ["a", "b|c", "d"]
    assert one(spark, C.split_list, "") is None
    assert one(spark, C.after_first_space, "BE32 Prov. Hainaut") == "Prov. Hainaut"
    assert one(spark, C.after_first_space, "nospace") == ""


def test_date_sequence(spark):
    df = spark.range(1).select(F.explode(C.date_sequence(F.lit(dt.date(2015, 12, 8)), F.lit(dt.date(2015, 12, 23)))))
    assert df.count() == 16
    df = spark.range(1).select(F.explode(C.date_sequence(F.lit(dt.date(2015, 12, 8)), F.lit(dt.date(2015, 12, 8)))))
    assert df.count() == 1
    assert one(spark, C.parse_yyyymmdd, "20191231") == dt.date(2019, 12, 31)
    assert one(spark, C.parse_yyyymmdd, "bad") is None


def test_indicators_and_scores(spark):
    df = spark.createDataFrame([("x", "", None, [], ["a"], 0.0, 2.5)],
                               "s string, e string, n string, ea array<string>, a array<string>, z double, v double")
    r = df.select(C.present("s"), C.present("e"), C.present("n"), C.present("ea", "array"), C.present("a", "array"),
                  C.present("z", "number"), C.present("v", "number")).first()
    assert list(r) == [100, 0, 0, 0, 100, 0, 100]
    m = spark.range(1).select(C.row_mean(F.lit(100), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(100))) \
        .first()[0]
    assert m == 28.57


def test_semver_and_value_by_type(spark):
    r = spark.createDataFrame([("1.10.2-rc1",)], "v string").select(C.semver("v").alias("s")).first()[0]
    assert (r.major, r.minor, r.patch) == (1, 10, 2)
    arr = spark.createDataFrame([([("A", "CALCULATED", 1.0), ("B", "CALCULATED", 2.0), ("B", "X", 3.0)],)],
                                "a array<struct<type:string,status:string,value:double>>")
    r = arr.select(C.value_by_type("a", "B"), C.value_by_type("a", "Z")).first()
    assert list(r) == [2.0, None]
