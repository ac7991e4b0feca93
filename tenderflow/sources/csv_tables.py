"""Typed CSV files (S5-S7): declared schema, codes as text, dates by format, unreadable rows kept apart.

No inference pass: the caller declares the types, so a code such as ``03000000`` stays text. Files are read in
parallel and split by Spark unless a quoted value may hold line breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: holds the text of a row that does not fit the schema, else null
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, date_format: str = "yyyyMMdd", sep: str = ",",
             multi_line: bool = False) -> DataFrame:
    """Rows in the declared types, header skipped, and ``CORRUPT``: a value that does not fit its type is null there."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.csv(path, schema=with_bad, header=True, sep=sep, dateFormat=date_format, mode="PERMISSIVE",
                          columnNameOfCorruptRecord=CORRUPT, multiLine=multi_line, enforceSchema=False)


def read_strings(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """S7 -- every column as text."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]), sep=sep)


def write_csv(df: DataFrame, path: str, date_format: str = "yyyyMMdd", sep: str = ",") -> None:
    df.write.csv(path, header=True, sep=sep, dateFormat=date_format)


def load_report(rows: DataFrame, by: str, day: str, amount: str) -> DataFrame:
    """Per value of ``by``: rows, rows that did not fit, first day and sum over those that did; one aggregation."""
    good = F.col(CORRUPT).isNull()
    return rows.groupBy(by).agg(F.count("*").alias("n_rows"), F.count_if(~good).alias("bad_rows"),
                                F.min(F.when(good, F.col(day))).cast("string").alias("first_day"),
                                F.round(F.sum(F.when(good, F.col(amount))), 2).alias("total"))
