"""Stores that the library keeps: days run again, a reference that grows, unions of graphs, parts read together."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tenderflow.operators import keyed as K
from tenderflow.operators import linkage as LK
from tenderflow.operators import registry as R
from tenderflow.sources import tables as S
from tenderflow.sources import triples as TR
from tests.conftest import SF
from tests.test_entry import _norm

D = dt.date


@pytest.mark.parametrize("name", ["reference_links", "reference_grown", "graph_union", "exported_parts", "document_store",
                                  "kept_reports"])
def test_store_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in S.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert _norm(E.queries()[name](spark, SF).toPandas()) == _norm(con.sql(E.oracle_sql()[name]).df())


def test_days_run_again_are_replaced(spark, tmp_path):
    path, schema = str(tmp_path / "days"), "d date, v int"
    first = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 2), 2), (D(2024, 1, 4), 4), (None, 5)], schema)
    counts = {r.day: r.rows for r in R.run_days(first, "d", D(2024, 1, 1), D(2024, 1, 4), path).collect()}
    assert counts == {D(2024, 1, 1): 1, D(2024, 1, 2): 2, D(2024, 1, 3): 0, D(2024, 1, 4): 1}
    later = spark.createDataFrame([(D(2024, 1, 1), 9), (D(2024, 1, 3), 3)], schema)
    R.run_days(later, "d", D(2024, 1, 2), D(2024, 1, 3), path)  # the second day has no rows any more, the first is not asked for
    assert sorted(map(tuple, R.read_days(spark, path).collect())) == [(D(2024, 1, 1), 1), (D(2024, 1, 3), 3), (D(2024, 1, 4), 4)]
    window = R.read_days(spark, path, D(2024, 1, 3), D(2024, 1, 3))
    assert [r.v for r in window.collect()] == [3]
    assert "PartitionFilters: [isnotnull(extract_day" in window._jdf.queryExecution().toString()


def test_days_take_timestamps_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23, 59), 1), (dt.datetime(2024, 1, 3), 2)], "d timestamp, v int")
    assert [tuple(r) for r in R.run_days(df, "d", D(2024, 1, 2), D(2024, 1, 2), str(tmp_path / "a")).collect()] == [(D(2024, 1, 2), 1)]
    none = R.run_days(df.where("false"), "d", D(2024, 1, 1), D(2024, 1, 2), str(tmp_path / "b")).collect()
    assert sorted(map(tuple, none)) == [(D(2024, 1, 1), 0), (D(2024, 1, 2), 0)]


def test_reference_grows_by_heads_of_new_clusters(spark):
    schema = "id string, name string, address string, country string"
    new = spark.createDataFrame([("0", "Acme", "1 Main St", "A"), ("1", "Solo", "2 Side St", "A"), ("2", "Solo", "2 Side St", "A")], schema)
    ref = spark.createDataFrame([("9", "Acme", "1 Main St", "A")], schema)
    grown = LK.grown_reference(ref, new, LK.link_to_reference(new, ref, "id"), "id")
    assert sorted(r.id for r in grown.collect()) == ["1", "9"]
    again = LK.link_to_reference(new, grown, "id")
    assert {r.unique_id_src: r.unique_id_dst for r in again.collect()} == {"0": "9", "1": "1", "2": "1"}
    assert LK.grown_reference(grown, new, again, "id").count() == 2


def test_union_of_graphs_is_a_set(spark):
    schema = "s string, p string, o string, o_kind string, lang string, dtype string, g string"
    rows = [("a", "p", "x", "literal", "en", None, None), ("a", "p", "x", "literal", None, None, None), ("a", "p", "x", "iri", None, None, None)]
    one, two = (TR.Graph(spark, triples=spark.createDataFrame(r, schema)) for r in (rows + rows[:1], rows[1:]))
    assert sorted(map(tuple, TR.union_graphs(one, two).triples().collect()), key=str) == sorted(rows, key=str)


def test_parts_of_unlike_columns_read_together(spark, tmp_path):
    path = str(tmp_path / "parts")
    K.append(spark.createDataFrame([(1, "a")], "id int, name string"), path, max_records_per_file=1, compression="gzip")
    K.append(spark.createDataFrame([(2, 0.5)], "id int, price double"), path, compression="gzip")
    K.append(spark.createDataFrame([(3,)], "id int"), path, compression="zstd")
    got = S.read_many(spark, path, "part-", ".gz.parquet").select("id", "name", "price")
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, None, 0.5)]


def _written(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_lines_are_kept_as_bounded_gzip_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TR, "LINES_A_FILE", 40)
    lines = spark.range(100).selectExpr("concat('<http://x/s', id, '> <http://x/p> \"v\" .') as value").coalesce(1)
    TR.write_lines(lines, str(tmp_path / "t"))
    files = _written(tmp_path / "t")
    assert len(files) == 3 and all(f.endswith(".txt.gz") for f in files)
    assert spark.read.text(str(tmp_path / "t")).distinct().count() == 100


def test_a_virtual_graph_is_stored_without_a_shuffle_and_reads_back(spark, tmp_path):
    a, b = spark.range(5), spark.range(3)
    iri = lambda k: F.concat(F.lit(f"http://x/{k}"), F.col("id"))
    g = TR.Graph(spark, branches={"http://x/p": [lambda: TR.branch(a, iri("a"), iri("b")), lambda: TR.branch(b, iri("c"), iri("d"), "literal", "en")],
                                  (TR.RDF_TYPE, "http://x/A"): [lambda: TR.branch(a, iri("a"), F.lit("http://x/A"))],
                                  (TR.RDF_TYPE, "http://x/C"): [lambda: TR.branch(b, iri("c"), F.lit("http://x/C"))], "http://x/none": []})
    path = str(tmp_path / "g")
    assert list(g.by_predicate) == ["http://x/p", TR.RDF_TYPE]
    TR.write_triples(g, path)
    back = TR.read_triples(spark, path, dedup=False)[0].triples()
    assert sorted(map(tuple, back.select(*TR.TRIPLE_SCHEMA.names).collect()), key=str) == \
        sorted(map(tuple, g.triples().select(*TR.TRIPLE_SCHEMA.names).collect()), key=str) and back.count() == 16
    assert all(f.endswith(".zstd.parquet") or ".zstd" in f for f in _written(path))
    TR.write_triples(g, path)  # over what was there
    assert spark.read.parquet(path).count() == 16
