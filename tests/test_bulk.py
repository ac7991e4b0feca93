from pyspark.sql import functions as F

from tenderflow.sources.bulk import load_quads, stored_graph

LINES = ['<http://x/a> <http://x/p> "1" <http://x/n1> .', '<http://x/a> <http://x/p> "1" <http://x/n1> .',
         '<http://x/b> <http://x/q> <http://x/a> <http://x/n1> .', '<http://x/c> <http://x/p> "2" <http://x/n2> .',
         '<http://x/c> <http://x/p> "broken <http://x/n2> .', '# a comment', '', 'no triple at all',
         '<http://x/d> <http://x/p> broken <http://x/n3>', '<http://x/e> <http://x/p> "3"@en <http://x/n4> .']


def write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(path)


def statuses(df):
    return {(r.notice.rsplit("/", 1)[1] if r.notice else None): (r.lines, r.bad_lines, r.status) for r in df.collect()}


def test_one_bad_line_condemns_its_notice(spark, tmp_path):
    text, store = str(tmp_path / "text"), str(tmp_path / "store")
    write(spark, text, LINES)
    got = statuses(load_quads(spark, text, store))
    assert got == {"n1": (3, 0, "loaded"), "n2": (2, 1, "quarantined"), "n3": (1, 1, "quarantined"), None: (1, 1, "quarantined"),
                   "n4": (1, 0, "loaded")}
    g = stored_graph(spark, store)
    assert g.triples().count() == 3 and g.pred("http://x/p").where("lang = 'en'").count() == 1


def test_loading_again_adds_new_notices_only(spark, tmp_path):
    text, store = str(tmp_path / "text"), str(tmp_path / "store")
    write(spark, text, LINES)
    load_quads(spark, text, store)
    write(spark, text, ['<http://x/f> <http://x/p> "9" <http://x/n5> .', '<http://x/c> <http://x/p> "late" <http://x/n4> .'])
    got = statuses(load_quads(spark, text, store))
    assert got["n1"] == (3, 0, "present") and got["n4"][2] == "present" and got["n5"] == (1, 0, "loaded")
    g = stored_graph(spark, store)
    assert g.triples().count() == 4 and g.triples().where(F.col("o") == "late").count() == 0
    assert "PartitionFilters: [isnotnull(p" in g.pred("http://x/p")._jdf.queryExecution().toString()


def test_empty_text(spark, tmp_path):
    text, store = str(tmp_path / "text"), str(tmp_path / "store")
    write(spark, text, [])
    assert load_quads(spark, text, store).count() == 0 and stored_graph(spark, store).triples().count() == 0


def test_the_set_of_triples_is_written_where_it_was_made(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame
    hints, plain = [], DataFrame.hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *a: hints.append(name) or plain(self, name, *a))
    write(spark, str(tmp_path / "text"), LINES)
    load_quads(spark, str(tmp_path / "text"), str(tmp_path / "store"))
    assert "rebalance" not in hints and stored_graph(spark, str(tmp_path / "store")).triples().count() == 3
