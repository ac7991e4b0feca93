import duckdb
import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F
from tenderflow.operators import keyed as K
from tenderflow.operators import search as S
from tenderflow.sources import csv_tables as C
from tenderflow.sources import tender_files as TF
from tenderflow.sources.json_docs import TENDER_SCHEMA
from tests.conftest import SF
from tests.test_entry import _norm


@pytest.mark.parametrize("name", ["tender_rows", "tender_bids", "search_nested", "search_mixed", "search_missing", "csv_report", "reindexed",
                                  "nuts_labels"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in "customer supplier part orders lineitem nation".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = _norm(E.queries()[name](spark, SF).toPandas())
    assert got == _norm(con.sql(E.oracle_sql()[name]).df()) and got


def test_csv_keeps_codes_and_unreadable_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('code;day;amount\n03000000;20200131;1.5\n"0;1";20201301;2\n09;20200201;x\n;;\n')
    rows = C.read_csv(spark, str(tmp_path), "code string, day date, amount double", sep=";").collect()
    assert [(r.code, str(r.day), r.amount, r[C.CORRUPT]) for r in rows] == [
        ("03000000", "2020-01-31", 1.5, None), ("0;1", "None", 2.0, '"0;1";20201301;2'), ("09", "2020-02-01", None, "09;20200201;x"),
        (None, "None", None, None)]
    text = C.read_strings(spark, str(tmp_path), ["code", "day", "amount"], sep=";").collect()
    assert text[2].amount == "x" and text[2][C.CORRUPT] is None


def test_json_arrays_are_parsed_for_the_asked_fields_only(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = TF.order_tenders(spark, SF)
    TF.write_json_arrays(docs, path, "tender.id", 3)
    back = TF.read_json_arrays(spark, path, ["tender.id", "tender.lots.bids.bidders.id"])
    assert back.schema.simpleString() == \
        "struct<tender:struct<id:string,lots:array<struct<bids:array<struct<bidders:array<struct<id:string>>>>>>>>"
    assert back.count() == docs.count()
    with pytest.raises(ValueError, match="absent"):
        TF.narrow(TENDER_SCHEMA, [["tender", "absent"]])


def test_search_conditions(spark):
    rows = [(1, "Fast Track", [{"k": "a", "v": 1, "in": [{"w": 5}]}, {"k": "b", "v": 9, "in": []}]), (2, None, []), (3, "slow track", None),
            (4, "", [{"k": None, "v": 9, "in": None}, {"k": "a", "v": None, "in": [{"w": None}]}])]
    d = spark.createDataFrame(rows, "id int, title string, xs array<struct<k:string, v:int, in:array<struct<w:int>>>>")

    def ids(c):
        return sorted(r.id for r in S.search(d, c, ["id"]).collect())
    assert ids(S.term("xs.k", "a")) == [1, 4]
    assert ids(S.all_of(S.term("xs.k", "a"), S.between("xs.v", low=9))) == [1, 4]
    assert ids(S.nested("xs", S.all_of(S.term("k", "a"), S.between("v", low=9)))) == []
    assert ids(S.nested("xs", S.all_of(S.term("k", "b"), S.between("v", 9, 9)))) == [1]
    assert ids(S.exists("xs.in.w")) == [1] and ids(S.none_of(S.exists("xs.in.w"))) == [2, 3, 4]
    assert ids(S.nested("xs", S.nested("in", S.term("w", 5)))) == [1]
    assert ids(S.match("title", "TRACK other")) == [1, 3] and ids(S.match("title", "fast track", every=True)) == [1]
    assert ids(S.any_of(S.terms("id", [2, 7]), S.match("title", "slow"))) == [2, 3]
    assert ids(S.all_of()) == [1, 2, 3, 4] and ids(S.any_of()) == []
    assert "Exchange" not in d.where(S.exists("xs.in.w")(F.col, d.schema))._jdf.queryExecution().toString()


def test_reindex_sets_conflicts_aside(spark, tmp_path):
    d = spark.createDataFrame([("1", "2020-01-01", "x"), ("one", "2020-01-01", "y"), (None, None, "z"), ("2", "never", None)],
                              "n string, day string, c string")
    ok, bad = K.reindex(d, str(tmp_path / "r"), {"n": "int", "day": "date"}, {"next": F.col("n") + 1})
    assert ok.schema.simpleString() == "struct<n:int,day:date,c:string,next:int>"
    assert sorted((str(r.n), r.c, str(r.next)) for r in ok.collect()) == [("1", "x", "2"), ("None", "z", "None")]
    assert sorted((r.n, r.day, r.c) for r in bad.collect()) == [("2", "never", None), ("one", "2020-01-01", "y")]
    none_bad, empty = K.reindex(d.where("n = '1'"), str(tmp_path / "s"), {"n": "int"})
    assert none_bad.count() == 1 and empty.count() == 0


def test_array_files_are_compressed_and_a_line_is_shuffled_once_by_order(spark, tmp_path):
    TF.write_json_arrays(spark.range(50).withColumnRenamed("id", "n"), str(tmp_path / "t"), "n", 4)
    files = [f for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4 and all(f.name.endswith(".gz") for f in files)
    assert spark.read.schema("n long").json(str(tmp_path / "t"), multiLine=True).distinct().count() == 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    plan = TF.order_tenders(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
