"""Operators with Python workers run where the workers cannot import the package."""

from tests.conftest import SF
from tests.test_session import REPO, run_elsewhere

CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as E
for name in ("op4_html_layout", "op10_embedding_near_dedup", "op11_hard_negatives", "op12_language_id"):
    assert E.queries()[name](spark, {sf!r}).count() > 0, name
print("fine")
"""


def test_workers_need_no_package(tmp_path):
    assert "fine" in run_elsewhere(CODE.format(repo=REPO, sf=SF), str(tmp_path))
