"""Work that must not grow faster than the tables: shuffles, files and lookups of round 3."""

import gzip
import json

from pyspark.sql import functions as F

from tenderflow.functions import columns as C
from tenderflow.operators import documents as DOC
from tenderflow.plans import catalog as CAT
from tenderflow.plans import tables as T
from tenderflow.sources import dims as D
from tenderflow.sources import json_docs as J
from tenderflow.sources import tender_files as TF
from tenderflow.sources.testdata_kg import build_graph

from .conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_indicators_are_searched_outside_lambdas(spark):
    ind = "array<struct<type:string,status:string,value:double>>"
    d = spark.createDataFrame([(1, [("a", "s", 1.0), ("b", "s", None), ("a", "s", 2.0), (None, "s", 9.0)]), (2, None), (3, [])], f"id int, x {ind}")
    got = DOC.with_indicators(d, "x", ["b", "a", "c"], "i_").drop("x")
    assert got.columns == ["id", "i_b", "i_a", "i_c"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None, 1.0, None), (2, None, None, None), (3, None, None, None)]
    text = plan(CAT.QUERIES["indicator_columns"](spark, SF))
    assert "lambdafunction(CASE" not in text and "lambdafunction(struct" not in text
    made = spark.createDataFrame([(-5, 2), (4, 3)], "a long, b long").select(J._indicators(["p", "q"], F.col("a"), F.col("b")).alias("x"))
    assert [[tuple(e) for e in r.x] for r in made.collect()] == [
        [("p", "CALCULATED", -100.0), ("q", "CALCULATED", -50.0)], [("p", "CALCULATED", 50.0), ("q", "INSUFFICIENT_DATA", None)]]


def test_array_files_are_written_where_the_documents_are(spark, tmp_path):
    docs = spark.range(0, 25, 1, 2).withColumnRenamed("id", "n").withColumn("s", F.lit('a "q"\n,'))
    TF.write_json_arrays(docs, str(tmp_path / "t"), docs_a_file=5)
    files = [json.loads(gzip.open(f, "rt", encoding="utf-8").read()) for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    assert len(files) == 6 and max(map(len, files)) == 5 and sorted(x["n"] for f in files for x in f) == list(range(25))
    back = spark.read.schema("n long, s string").json(str(tmp_path / "t"), multiLine=True)
    assert back.count() == 25 and back.where(F.col("s") == 'a "q"\n,').count() == 25


def test_a_lots_table_is_dealt_by_its_key_once(spark):
    keys = T.t_lot(build_graph(spark, SF), D.rates(spark, SF)).groupBy("LotId").count()
    assert plan(keys).count("Exchange hashpartitioning(LotId") == 1 and "Exchange hashpartitioning(LotEst" not in plan(keys)


def test_local_name_ends_alike(spark):
    names = ["http://a/b#Lot_1", "http://a#b/c", "x", "", "a/", "a#", "a/b\n", None, "#/"]
    got = spark.createDataFrame([(n,) for n in names], "c string").select(
        C.local_name("c").alias("new"), F.when(F.col("c").isNotNull(), F.regexp_extract("c", r"([^/#]*)$", 1)).alias("old"))
    assert "regexp_extract" not in plan(got.select("new")) and all(r.new == r.old for r in got.collect())
