import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like frame from (doc_id, text[, source]) rows, with a column whose name clashes with results."""
    def make(rows, extra=True):
        rows = [(*r, "s")[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.selectExpr("*", "'x' as lang", "1 as component_id", "'y' as score", "0 as size") if extra else df
    return make
