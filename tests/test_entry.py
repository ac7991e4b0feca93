import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

FAST = ["link_records", "table_organization_deduplication", "report_q1", "report_q2", "report_q4", "report_q7", "report_q15", "report_q24", "table_notice",
        "table_lot_cpv", "keep_first", "upsert_last", "incremental_load", "best_version", "explode_tenders",
        "cpv_dim", "convert_dated", "preferred_text", "sme_share", "kpi_sme", "run_plan", "list_columns", "document_count",
        "document_page", "required_documents", "cast_documents", "nuts_by_level", "insert_if_absent_raw", "score_columns",
        "indicator_columns", "lot_indicator_columns", "table_notice_window", "table_cpv", "table_nuts", "report_q3",
        "convert_last", "scan_triples"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Winner_Country", "Lots_using_EU_Funds"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(pdf):
    pdf = pdf[sorted(pdf.columns)]
    for c in pdf.columns:
        if str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].astype(str)
    return sorted(tuple("NULL" if v is None or v != v else str(v) for v in row) for row in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = _norm(E.queries()[name](spark, SF).toPandas())
    want = _norm(con.sql(E.oracle_sql()[name]).df())
    assert got == want
