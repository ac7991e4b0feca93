"""Star patterns: the stored graph and the virtual one give the same rows; plans stay short."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from tenderflow.operators.graph import match, optional, pattern
from tenderflow.operators.star import node, star, text, value
from tenderflow.plans import lots as X
from tenderflow.plans import reports as R
from tenderflow.plans import tables as T
from tenderflow.sources import dims as D
from tenderflow.sources.testdata_kg import build_graph
from tenderflow.sources.triples import Graph, read_triples, write_triples
from tests.conftest import SF

WEEK = ("19950101", "19950331")


@pytest.fixture(scope="module")
def graphs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("graph") / "triples")
    g = build_graph(spark, SF)
    write_triples(g, path)
    return g, read_triples(spark, path)[0]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


RATED = {"procedure": T.t_procedure, "lot": T.t_lot, "statistics": T.t_submission_statistics}
PLAIN = {"winner": T.t_winner, "contact": T.t_contact_point, "place": T.t_place_of_performance, "lots": X.build_lots}


@pytest.mark.parametrize("name", [*RATED, *PLAIN])
def test_stored_graph_equals_virtual(spark, graphs, name):
    rates = D.rates(spark, SF)
    a, b = (RATED[name](g, rates, WEEK) if name in RATED else PLAIN[name](g, WEEK) for g in graphs)
    a = rows(a)
    assert a and a == rows(b)


@pytest.mark.parametrize("name", ["q4", "q26"])
def test_reports_on_a_stored_graph(graphs, name):
    a, b = (rows(R.REPORTS[name](g)) for g in graphs)
    assert a and a == b


NT = [("a", "type", "Parcel", "iri", None), ("b", "type", "Parcel", "iri", None), ("x", "type", "Other", "iri", None),
      ("a", "title", "Los", "literal", "de"), ("a", "title", "Lot", "literal", "en"), ("b", "title", "z", "literal", "fr"),
      ("b", "title", "y", "literal", "pl"), ("a", "tag", "1", "literal", None), ("a", "tag", "2", "literal", None),
      ("x", "tag", "3", "literal", None), ("a", "price", "m1", "iri", None), ("b", "price", "m2", "iri", None),
      ("m1", "amount", "5", "literal", None), ("m1", "cur", "EUR", "iri", None), ("m2", "amount", "no", "literal", None),
      ("m2", "cur", "EUR", "iri", None), ("n", "has", "a", "iri", None), ("n", "has", "b", "iri", None), ("o", "has", "a", "iri", None),
      ("n", "day", "20200131", "literal", None), ("o", "day", "20200199", "literal", None)]


def small(spark):
    from tenderflow.vocab import RDF_TYPE
    df = spark.createDataFrame([(s, RDF_TYPE if p == "type" else p, o, k, lang, None, None) for s, p, o, k, lang in NT],
                               "s string, p string, o string, o_kind string, lang string, dtype string, g string")
    return Graph(spark, triples=df)


def test_stored_star_equals_joins(spark):
    g = small(spark)
    money = node("m", {"amount": value("amt", required=True, cast="double"), "cur": value("cur", required=True)})
    got = star(g, node("s", {"title": text("t"), "tag": value("tag"), "price": money, "^has": value("n")}, cls="Parcel"))
    lots = g.pred("http://www.w3.org/1999/02/22-rdf-syntax-ns#type").where("o = 'Parcel'").select("s")
    mv = match(pattern(g, "price", "s", "m"), match(pattern(g, "amount", "m", "amt", cast="double").where("amt is not null"),
                                                    pattern(g, "cur", "m", "cur")))
    want = optional(optional(optional(lots, pattern(g, "tag", "s", "tag")), mv), pattern(g, "has", "n", "s"))
    want = optional(want, spark.createDataFrame([("a", "Lot"), ("b", "y")], "s string, t string"))
    assert rows(got) == rows(want.select(*got.columns))
    assert {(r.s, r.amt) for r in got.collect()} == {("a", 5.0), ("b", None)}


def test_day_window_ignores_days_that_do_not_exist(spark):
    g = small(spark)
    got = star(g, node("n", {"day": value("d", required=True, between=("20200101", "20201231"))}))
    assert [r.n for r in got.collect()] == ["n"]


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_plans_are_short_and_the_window_reaches_the_scan(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        g, rates = build_graph(spark, SF), D.rates(spark, SF)
        lots, lot, window = (explained(d) for d in (X.build_lots(g), T.t_lot(g, rates), T.t_notice(g, rates, WEEK)))
        assert lots.count("Exchange hashpartitioning") <= 12
        assert lot.count("Exchange hashpartitioning") <= 4
        assert "GreaterThanOrEqual(o_orderdate,1995-01-01" in window
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_customers_are_distinct_by_the_columns_inside_their_texts(spark, tmp_path, monkeypatch):
    rows_of = {"orders": spark.read.parquet(f"{SF}/orders.parquet").limit(40), "supplier": spark.read.parquet(f"{SF}/supplier.parquet").limit(8)}
    keys = rows_of["orders"].selectExpr("o_orderkey as l_orderkey").crossJoin(rows_of["supplier"].selectExpr("s_suppkey as l_suppkey"))
    line = spark.read.parquet(f"{SF}/lineitem.parquet").limit(3).drop("l_orderkey", "l_suppkey").crossJoin(keys)
    rows_of["lineitem"] = line.union(line.selectExpr(*[f"{c} + 480 * 4 as {c}" if c == "l_partkey" else c for c in line.columns])) \
        .selectExpr(*[f"nullif({c}, 1) as {c}" if c == "l_linenumber" else c for c in spark.read.parquet(f"{SF}/lineitem.parquet").columns])
    # rows that repeat, two suppliers of one name, one named as another's second name
    named = {0: "s_name", 1: "'Fournisseur 3'", 2: "'twin'", 3: "'twin'"}
    rows_of["supplier"] = rows_of["supplier"].selectExpr(*[
        "case s_suppkey % 4 " + " ".join(f"when {k} then {v}" for k, v in named.items()) + " end as s_name" if c == "s_name" else
        "9.5d as s_acctbal" if c == "s_acctbal" else c for c in rows_of["supplier"].columns])
    rows_of["supplier"] = rows_of["supplier"].union(rows_of["supplier"].limit(3))
    for f in os.listdir(SF):
        if (t := f.removesuffix(".parquet")) in rows_of:
            rows_of[t].write.parquet(str(tmp_path / f))
        else:
            os.symlink(f"{SF}/{f}", tmp_path / f)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        g = build_graph(spark, str(tmp_path))
        got = R.q26_potential_customers(g)
        plan = explained(got)
        assert plan.count("Exchange hashpartitioning") == 4 and "Exchange hashpartitioning(LotCPV" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    monkeypatch.setattr(R, "distinct_star", lambda g, root, names, **casts: star(g, root).select(
        *[F.col(c).cast(casts.get(c, "string")) for c in names]).distinct())
    want = R.q26_potential_customers(g)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert rows(got) == rows(want) and 100 < got.count() == got.distinct().count() < rows_of["lineitem"].count() * 2
