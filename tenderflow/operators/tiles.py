"""Group-wise pair comparison with bounded tasks.

``tiled`` gives every row of a keyed table one or more tiles. A group of up to
``block`` rows is one tile. A larger group is cut into blocks by a hash of the
row id, and each pair of blocks is one tile, so that no task ever holds more
than two blocks whatever the size of the group; every pair of rows of a group
meets in exactly one tile. ``whole_groups`` streams a sorted partition and
hands out runs of complete tiles.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tiled(df: DataFrame, key: str, row_id: str, block: int, least: int = 2) -> DataFrame:
    """Rows of groups with at least ``least`` rows, plus ``ti``, ``tj`` (tile) and ``blk`` (the row's block)."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    nb = F.ceil(F.col("_n") / block).cast("int")
    rows = df.join(n, key).withColumn("_nb", nb).withColumn("blk", F.pmod(F.xxhash64(row_id), F.col("_nb")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("_nb") - 1),
                         lambda k: F.struct(F.least(k, F.col("blk")).alias("i"), F.greatest(k, F.col("blk")).alias("j")))
    return rows.withColumn("_t", F.explode(others)).withColumn("ti", F.col("_t.i")).withColumn("tj", F.col("_t.j")) \
        .drop("_t", "_n", "_nb")


def dealt(tiles: DataFrame, key: str) -> DataFrame:
    """Tiles dealt out to tasks and sorted, ready for ``whole_groups``."""
    return tiles.repartition(key, "ti", "tj").sortWithinPartitions(key, "ti", "tj")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches re-cut so that no group of equal ``keys`` is split (input sorted by them)."""
    parts: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        same = (k == k[-1]).all(axis=1)
        start = len(b) - int(same[::-1].argmin()) if not same.all() else 0
        if start:  # the batch's last group starts inside it: everything before is complete
            yield pd.concat([*parts, b.iloc[:start]], ignore_index=True) if parts else b.iloc[:start]
            parts = [b.iloc[start:]]
        elif parts and (parts[-1][keys].iloc[-1].to_numpy() != k[0]).any():
            yield pd.concat(parts, ignore_index=True)
            parts = [b]
        else:
            parts.append(b)
    if parts:
        yield pd.concat(parts, ignore_index=True)


def segment_ids(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """0, 1, 2 ... per run of equal keys."""
    k = pdf[keys].to_numpy()
    return np.concatenate([[0], np.cumsum((k[1:] != k[:-1]).any(axis=1))]) if len(k) else np.zeros(0, int)
