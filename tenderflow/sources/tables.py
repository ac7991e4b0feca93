"""Driver tables: one parquet file per table under an ``sf_dir``.

Reads are lazy; Catalyst prunes columns and pushes filters into each scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


class Tables:
    """Name -> DataFrame accessor over a directory of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            # one reader per table: schema discovery runs once, every branch reuses the relation
            if name not in self._frames:
                self._frames[name] = self.spark.read.parquet(self.path(name))
            return self._frames[name]
        raise AttributeError(name)

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)


def read_many(spark: SparkSession, folder: str, prefix: str = "", suffix: str = ".parquet") -> DataFrame:
    """S12/U3 -- every parquet file of a folder selected by prefix/suffix, columns unioned by name
    (a column missing from a file reads as null); Spark lists and splits the files, no driver loop."""
    return spark.read.option("mergeSchema", "true").option("pathGlobFilter", f"{prefix}*{suffix}").parquet(folder)
