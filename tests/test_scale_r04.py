"""Work that must not grow faster than the tables: lines, stores, lots and keys of round 4."""

from pyspark.sql import functions as F

from tenderflow.operators import taxonomy as TX
from tenderflow.plans import lots as X
from tenderflow.session import settings
from tenderflow.sources import bulk as B
from tenderflow.sources import triples as TR
from tenderflow.sources.testdata_kg import build_graph
from tenderflow.vocab import V

from .conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_matched_once(spark, tmp_path):
    long = "x" * 20000 + '\\"' * 4000
    lines = ['<http://x/a> <http://x/p> "1"@en <http://x/g> .', "  # note", "", "no triple", '<http://x/a> <http://x/p> "open .',
             f'<http://x/b> <http://x/p> "{long}" .', "\u0001" * 10, "_:b <http://x/p> <http://x/o> .", "<# no comment", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    triples, rejected = TR.parse_ntriples(df)
    assert plan(triples).count("regexp_replace(") == 1 and "regexp_replace" not in plan(rejected)
    assert {r.line for r in rejected.collect()} == {"no triple", lines[4], "\u0001" * 10, "<# no comment"}
    got = {r.s: (r.o, r.o_kind, r.lang, r.g) for r in triples.collect()}
    assert got == {"http://x/a": ("1", "literal", "en", "http://x/g"), "http://x/b": ("x" * 20000 + '"' * 4000, "literal", None, None),
                   "_:b": ("http://x/o", "iri", None, None)}


def test_an_iri_of_several_columns_is_minted_once(spark):
    lots = plan(build_graph(spark, SF).pred(V["includesLot"]))
    assert lots.count("_Contract") == 1 and lots.count("_Lot_") == 1 and "IsNotNull(l_partkey)" in lots
    rows = spark.createDataFrame([(1, 2), (None, 3), (4, None)], "a int, b int")
    term = TR.Term("x", F.concat(F.lit("x"), "a", F.lit("-"), "b"), parts=(F.col("a"), F.col("b")))
    both = [TR.Mapped(TR.Rows("r", lambda: rows), t, F.concat(F.lit("o"), F.col("a"))) for t in (term, TR.Term("x", term.col))]
    assert [[(r.s, r.o) for r in b.frame().collect()] for b in both] == [[("x1-2", "o1")]] * 2


def test_triples_of_a_class_read_its_rules_only(spark):
    def unread():
        raise AssertionError("another rule's rows were read")
    ids = spark.range(3)
    a, b = (TR.Term(k, F.concat(F.lit(f"http://x/{k}"), F.col("id")), parts=(F.col("id"),)) for k in "ab")
    rows, other = TR.Rows("r", lambda: ids), TR.Rows("r", unread)
    loose = lambda: TR.branch(ids, F.concat(F.lit("http://x/"), F.when(F.col("id") < 2, "a").otherwise("b"), F.col("id")), F.lit("v"), "literal")
    branches = {"p": [lambda: TR.Mapped(rows, a, b), lambda: TR.Mapped(other, b, a), loose, lambda: TR.About("b", unread)],
                (TR.RDF_TYPE, "A"): [lambda: TR.Mapped(rows, a, F.lit("A"))], (TR.RDF_TYPE, "B"): [lambda: TR.Mapped(other, b, F.lit("B"))]}
    g = TR.Graph(spark, branches=branches, class_patterns={"A": "^http://x/a"})
    got = sorted((r.s, r.p, r.o) for r in g.triples(of="A").collect())
    assert got == sorted([(f"http://x/a{k}", "p", f"http://x/b{k}") for k in range(3)] + [(f"http://x/a{k}", TR.RDF_TYPE, "A") for k in range(3)]
                         + [(f"http://x/a{k}", "p", "v") for k in range(2)])
    stored = TR.Graph(spark, triples=build_graph(spark, SF).triples(of=V["ResultNotice"]))
    assert stored.triples(of=V["ResultNotice"]).count() == stored.triples().count()
    assert stored.triples().count() == build_graph(spark, SF).triples().where(F.col("s").endswith("_Notice")).count()


def test_a_status_takes_one_pass_over_the_text(spark, tmp_path, monkeypatch):
    frame, plans = type(spark.range(1)), []
    kept = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: plans.append(plan(self)) or kept(self, *a, **k))
    text = '<http://x/a> <http://x/p> "1" <http://x/n> .\n<http://x/a> <http://x/p> "1 <http://x/n> .\n'
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text(text)
    got = B.load_quads(spark, str(tmp_path / "text"), str(tmp_path / "store"))
    assert plans[0].count("Scan text") == 1 and [tuple(r) for r in got.collect()] == [("http://x/n", 2, 1, "quarantined")]


def test_lots_are_dealt_by_their_order_alone(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with settings(spark, conf | X.in_place(spark)):
        dealt = plan(X.build_lots(build_graph(spark, SF)))
    assert dealt.count("Exchange hashpartitioning") <= 9 and "Exchange hashpartitioning(lot" not in dealt
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    g = build_graph(spark, SF)
    g.mapping.dealt.clear()  # where no such column is known the lots are the same
    with settings(spark, X.in_place(spark)):
        same = [sorted(map(str, X.build_lots(x).collect())) for x in (g, build_graph(spark, SF))]
    assert same[0] == same[1] and len(same[0]) > 5000


def test_equal_code_lists_are_worked_out_once(spark):
    dim = TX.cpv_dim(spark.createDataFrame([("63712000", "a"), ("63710000", "b"), ("63700000", "c"), ("63000000", "d")], "code string, label string"))
    lots = spark.range(1000).select("id", F.when(F.col("id") % 5 == 0, F.array()).when(F.col("id") % 5 < 4, F.array(
        F.lit("63712000"), F.when(F.col("id") % 2 == 0, "x").otherwise("63710000"))).alias("codes"))
    out = TX.cpv_list_columns(lots, "id", "codes", dim)
    assert "Exchange hashpartitioning" not in plan(out) and "BroadcastHashJoin" in plan(out)
    got = {r.id: r for r in out.collect()}
    assert len(got) == 1000 and got[5].codes is got[4].codes is got[0].cpv0 is None
    assert (got[1].codes, got[1].cpv_level, got[1].cpv_parent, got[1].cpv1, got[1].cpv4) == (["a", "b"], [3, 2], ["c", "b"], ["c"], None)
    assert (got[2].codes, got[2].cpv_level, got[2].cpv3) == (["a", None], [3, None], ["a"])


def test_stored_iris_are_written_as_what_differs(spark, tmp_path):
    import pyarrow.parquet as pq
    ids = spark.range(0, 60000, 1, 1)
    g = TR.Graph(spark, branches={"http://x/p": [lambda: TR.branch(ids, F.concat(F.lit("http://x/a_"), F.col("id")), F.concat(F.lit("http://x/b_"), F.col("id")))]})
    TR.write_triples(g, str(tmp_path / "g"))
    (file,) = (tmp_path / "g").rglob("part-*")
    assert "DELTA_BYTE_ARRAY" in pq.ParquetFile(file).metadata.row_group(0).column(0).encodings
    back = TR.read_triples(spark, str(tmp_path / "g"), dedup=False)[0].pred("http://x/p")
    assert back.join(ids, F.col("s") == F.concat(F.lit("http://x/a_"), F.col("id"))).where(F.col("o") == F.concat(F.lit("http://x/b_"), F.col("id"))).count() == 60000
