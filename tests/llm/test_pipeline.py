import random

import corpus_pipeline as P
from tests.llm.test_decontamination import words
from tests.llm.test_quality import junk, natural


def test_stages_run_in_order_and_take_effect(spark, tmp_path):
    rng = random.Random(11)
    item = " ".join(words(rng, 30))
    rows = [(i, natural(rng, 80), "en", f"s{i % 3}") for i in range(60)]
    shared = natural(rng, 40)
    rows += [(100 + i, junk(rng, 80), "en", "s0") for i in range(12)]
    rows += [(200, rows[0][1], "en", "s1"), (201, rows[5][1] + " And one more.", "en", "s1")]
    rows += [(300 + i, f"{natural(rng, 60)}\n{shared}\n{natural(rng, 60)}", "en", "s2") for i in range(3)]
    rows += [(400, f"{natural(rng, 60)} {item} {natural(rng, 60)}", "en", None), (401, None, None, None), (402, "", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string") \
        .selectExpr("*", "cast(length(text) as int) as n_chars", "1 as component_id", "2 as target")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, now = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        assert name == P.STAGES[-1][0] or out.columns == docs.columns
        now = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id: r for r in now.collect()})
    quality, lines, near, clean, mix = seen
    assert not any(100 <= i < 112 or i in (401, 402) for i in quality) and len(quality) >= 60
    assert set(lines) == set(quality)
    assert shared in lines[300].text and all(shared not in lines[i].text for i in (301, 302))
    assert all(r.n_chars == len(r.text) for r in lines.values())
    assert 200 not in near or near[200].text == ""
    assert 400 in near and 400 not in clean and set(near) - {400} == set(clean)
    assert set(mix) == set(clean)
    ran = {r.doc_id: r.taken for r in P.run(spark, str(tmp_path)).collect()}
    assert ran == {i: r.taken for i, r in mix.items()}


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
