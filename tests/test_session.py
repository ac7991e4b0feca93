"""A plain session without spark.checkpoint.dir, and one whose Python workers cannot import the package."""

import os
import subprocess
import sys

from tests.conftest import SF

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PLAIN = """
import os, sys
os.environ["SPARK_CONF_DIR"] = os.getcwd()
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as E
from tenderflow.session import ensure_checkpoint_dir
assert E.entry(spark).count() > 0
assert E.queries()["table_cpv"](spark, {sf!r}).count() > 0
assert ensure_checkpoint_dir(spark).rstrip("/") in spark.sparkContext.getCheckpointDir()
print("fine")
"""


def run_elsewhere(code: str, cwd: str) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_session_without_checkpoint_folder(tmp_path):
    assert "fine" in run_elsewhere(PLAIN.format(repo=REPO, sf=SF), str(tmp_path))
