"""S15/S16 -- bulk load of notices from N-Quads text: whole notices or nothing, with a status for each.

The graph name of a line is its notice. A line that does not parse condemns its notice: an anti-join on the graph name
keeps all of the notice's triples out of the store, and the status table says why. A broken line still names its graph if
it ends in an IRI; lines that do not are reported under a null notice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import read_if_there
from .triples import STORE_OPTIONS, TRIPLE_SCHEMA, Graph, parse_lines

LOADED, QUARANTINED, PRESENT = "loaded", "quarantined", "present"


def _notice() -> Column:
    """The graph that a parsed line names; for one that did not parse the IRI it ends in."""
    name = F.regexp_extract("line", r"<([^<>\s]*)>\s*\.?\s*$", 1)
    return F.when(F.col("ok"), F.col("g")).when(name != "", name)


def load_quads(spark: SparkSession, text_path: str, store: str) -> DataFrame:
    """Append the sound notices of N-Quads text to the store (Parquet by predicate); returns their status.

    (notice, lines, bad_lines, status): ``loaded``, ``quarantined``, or ``present`` for a notice that the store held before
    (its lines are left out: loading a folder again changes nothing). The store stays a set of triples.
    """
    lines = parse_lines(spark.read.text(text_path))
    old = read_if_there(spark, f"{store}/triples")
    known = spark.createDataFrame([], "notice string") if old is None else old.select(F.col("g").alias("notice")).distinct()
    status = lines.groupBy(_notice().alias("notice")).agg(F.count("*").alias("lines"), F.count_if(~F.col("ok")).alias("bad_lines"))
    status = status.join(known.withColumn("_known", F.lit(True)), "notice", "left").withColumn(
        "status", F.when(F.col("_known"), PRESENT).when(F.col("bad_lines") > 0, QUARANTINED).otherwise(LOADED)) \
        .drop("_known").checkpoint()  # before the store changes
    out = status.where(F.col("status") != LOADED).select(F.col("notice").alias("g"))
    kept = lines.where("ok and g is not null").join(out, "g", "left_anti").select(*TRIPLE_SCHEMA.names).distinct()
    # written where the set was made: a rebalance by predicate would shuffle every triple once more
    kept.write.mode("append").partitionBy("p").options(**STORE_OPTIONS).parquet(f"{store}/triples")
    return status


def stored_graph(spark: SparkSession, store: str) -> Graph:
    """The graph of a store: a set already, so nothing is removed when it is read."""
    return Graph(spark, triples=spark.read.schema(TRIPLE_SCHEMA).parquet(f"{store}/triples"))
