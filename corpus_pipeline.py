"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, source mixing.

Each stage reads what its predecessor kept, as Parquet in the shared checkpoint folder, so a lost
executor or driver costs one stage at most. Stages 1 to 4 return the columns of ``documents``
(extra columns too); the last returns the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderflow.llm import decontamination, lines, mixing, quality, simhash
from tenderflow.session import ensure_checkpoint_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go; wordless ones go with them."""
    ensure_checkpoint_dir(spark)
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; every document stays, ``n_chars`` follows the text."""
    ensure_checkpoint_dir(spark)
    out = lines.dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints the document with the smallest doc_id stays."""
    ensure_checkpoint_dir(spark)
    return simhash.keep_first_of_group(docs, simhash.near_duplicates(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, verbatim or edited, go."""
    ensure_checkpoint_dir(spark)
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What each document gives to the mix: words taken, whole epochs and the word ranges taken once more."""
    ensure_checkpoint_dir(spark)
    return mixing.mix(docs)[0]


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: expectation-maximisation, fingerprints and alignment are not SQL: tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
