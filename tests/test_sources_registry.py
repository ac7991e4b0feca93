import datetime as dt

from pyspark.sql import functions as F

from tenderflow.operators import documents as DOC
from tenderflow.operators import keyed as K
from tenderflow.operators import registry as RG
from tenderflow.sources import json_docs as J
from tenderflow.sources.testdata_kg import build_graph
from tenderflow.sources.triples import read_triples, write_triples
from tests.conftest import SF


def test_json_round_trip_and_flatten(spark, tmp_path):
    docs = J.tender_documents(spark, SF)
    path = str(tmp_path / "tenders")
    J.write_json(docs, path, max_records_per_file=1000)
    back = J.read_tenders(spark, path)
    assert back.count() == docs.count()
    flat = DOC.flatten_struct(back, "_", keep_arrays=False)
    assert "tender_addressOfImplementation_nuts" in flat.columns
    bidders = DOC.explode_path(back, "tender", ["lots", "bids", "bidders"])
    assert bidders.count() == docs.count()
    req = DOC.required(flat.withColumn("tender_size", F.col("tender_size")), ["tender_size", "missing_field"])
    assert req.where(F.col("tender_size").isNull()).count() == 0
    cast = DOC.cast_fields(flat.select("tender_id", "tender_estimatedPrice_netAmount"),
                           ["tender_estimatedPrice_netAmount"])
    assert dict(cast.dtypes)["tender_estimatedPrice_netAmount"] == "double"


def test_physical_graph_round_trip(spark, tmp_path):
    """A virtual graph stored as parquet partitioned by predicate reads back as the same triple set."""
    g = build_graph(spark, SF)
    from tenderflow.sources.triples import Graph
    sub = Graph(spark, branches={k: v for k, v in g._branches.items()
                                 if k in ("http://example.org/epo#hasPublicationDate",
                                          "http://example.org/epo#refersToProcedure")})
    path = str(tmp_path / "triples")
    write_triples(sub, path)
    back, rejected = read_triples(spark, path)
    assert rejected.count() == 0
    assert back.pred("http://example.org/epo#hasPublicationDate").count() == \
        sub.pred("http://example.org/epo#hasPublicationDate").distinct().count()


def test_registry_plan_and_days(spark):
    p = {r.target: (r.start, r.end) for r in RG.plan(spark, dt.date(2024, 7, 1), ["Notice", "Lot"]).collect()}
    free = dt.date(2024, 7, 1) - dt.timedelta(days=181)   # the day before the run, lagged 180 days
    assert p["tier_free"] == (free, free)
    assert p["tier_premium"] == (dt.date(2024, 6, 30), dt.date(2024, 6, 30))
    assert p["Notice"] == (dt.date(2024, 6, 30), dt.date(2024, 6, 30))
    assert RG.days(spark, dt.date(2015, 12, 8), dt.date(2015, 12, 23)).count() == 16


def test_reset_status_only_selected(spark):
    reg = spark.createDataFrame([(1, "RAW"), (2, "RAW"), (3, "INDEXED")], "notice_id long, status string")
    out = {r.notice_id: r.status for r in RG.reset_status(reg, reg.where("notice_id in (1, 3)"), "RAW", "INDEXED")
           .collect()}
    assert out == {1: "INDEXED", 2: "RAW", 3: "INDEXED"}


def test_store_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert K.count(df).first()[0] == 3
    assert K.query(df, F.col("k") > 1, ["v"], size=1).count() == 1
    path = str(tmp_path / "store")
    K.append(df, path)
    K.clear(spark.read.parquet(path), str(tmp_path / "store2"))
    assert spark.read.parquet(str(tmp_path / "store2")).count() == 0


def test_read_many_unions_columns(spark):
    from tenderflow.sources.tables import read_many
    df = read_many(spark, SF, prefix="", suffix="ion.parquet")   # nation.parquet + region.parquet
    assert {"n_nationkey", "r_regionkey"} <= set(df.columns)
    assert df.count() == 25 + 5
