import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tenderflow.llm.queries import ORACLES, QUERIES
from tests.conftest import SF


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(str(tuple(None if pd.isna(v) else v for v in r)) for r in pdf.itertuples(index=False, name=None))


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(QUERIES)
    assert all(isinstance(v, str) for v in E.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = E.queries()[name](spark, SF), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert [r.replace(".0", "") for r in rows(got.toPandas())] == [r.replace(".0", "") for r in rows(want)]


def test_quality_labels_of_the_table(spark):
    """The classifier never sees the labels table; it must agree with it."""
    kept = {r.doc_id: r.keep for r in QUERIES["op1_quality_classifier"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    wrong = [r.doc_id for r in labels if kept[r.doc_id] != (r.quality == 1)]
    assert len(wrong) <= 0.03 * len(labels)
