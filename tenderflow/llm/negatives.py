"""Operator 11: hard-negative mining with the threshold algorithm.

Scores are integer inner products of quantised vectors. Every anchor first needs its ``k`` best rows of its own label
(the positives), then per positive the ``k`` best rows of other labels inside a window under the positive's score. Both
are the same search: the best ``k`` rows whose score lies in [lo, hi], for several windows of one anchor at once.

**Search (Fagin's threshold algorithm).** Rows are dealt into blocks of about ``BLOCK`` by a hash; a block keeps, per
dimension, its rows sorted by that component. An anchor reads the lists in parallel, from the top where its own
component is positive, from the bottom where it is negative, and not at all where it is zero (sorted access); every
row met for the first time is scored whole (random access, integers). After each round the threshold is the score that
a row at the present depth of all lists would have: no unseen row can exceed it. The anchor stops in the block once
the threshold is strictly below the k-th score of every window, or below the window's lower end. Strictly, so that
all rows that tie with the k-th are seen.

**Blocks.** Positives are searched in blocks of the anchor's label, negatives in blocks of all rows (rows of the
anchor's label are read but never taken). Anchors are dealt into chunks of about ``CHUNK``; a task holds one block and
one chunk, whatever the size of a label, and returns at most ``k`` rows per window. The best of all blocks are ranked
by a window function that prunes before its shuffle. Nothing is collected or broadcast.

Defined results: rows take no part if id, label or vector is null or a component is null, NaN or infinite (an empty
vector scores 0). Vectors of different length have no score. Equal rows (id, label and vector) count once; other rows of
one id are rows of their own, told apart by a hash in ties. Sums are exact: doubles while they hold all integers in
reach, Python integers beyond; a returned score that no long can hold is an error. Other input columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 5
#: a negative's score lies within these percentages of the positive's
LOW, HIGH = 80, 100
SCALE = 256
#: rows of a block, anchors of a chunk
BLOCK, CHUNK = 1 << 13, 1 << 12
#: rounds that read a whole list
ROUNDS = 32


class Lists:
    """The rows of a block with one sorted list per dimension."""

    def __init__(self, q: np.ndarray):
        self.q = q
        self.order = np.argsort(q, axis=0, kind="stable").T.copy()  # dimension x rows, ascending
        self.value = np.take_along_axis(q, self.order.T, axis=0).T

    def search(self, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) of all allowed rows met before the stop; they hold the best ``k`` of every window."""
        n = len(self.q)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):  # no list to read: every score is zero
            rows = np.flatnonzero(allowed)
            return rows, self.q[rows] @ anchor
        step = max(16, -(-n // ROUNDS))
        unseen, best = np.ones(n, dtype=bool), [np.zeros(0, dtype=self.q.dtype) for _ in lo]
        met, scores = [], []
        for depth in range(0, n, step):
            to = min(depth + step, n)
            new = np.zeros(n, dtype=bool)
            new[self.order[up, n - to:n - depth]] = True
            new[self.order[down, depth:to]] = True
            new &= unseen
            unseen &= ~new
            rows = np.flatnonzero(new & allowed)
            s = self.q[rows] @ anchor
            met.append(rows)
            scores.append(s)
            threshold = self.value[up, n - to] @ anchor[up] + self.value[down, to - 1] @ anchor[down]
            ranked, go_on = np.sort(s), False
            for w in range(len(lo)):
                end = np.searchsorted(ranked, hi[w], "right")
                best[w] = np.sort(np.concatenate([best[w], ranked[max(0, end - k):end]]))[-k:]
                kth = best[w][0] if len(best[w]) == k else lo[w]
                go_on |= not threshold < max(kth, lo[w])
            if not go_on:
                break
        return np.concatenate(met), np.concatenate(scores)


def matrix(column: pd.Series, top: float) -> np.ndarray:
    """Vectors as rows of integers: doubles while every sum of products (times a percentage) is exact, else objects."""
    q = np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))
    return q if top * top * max(q.shape[1], 1) * HIGH < 2 ** 53 else np.array([[int(v) for v in r] for r in q], dtype=object)


def _tile(k: int, other_label: bool):
    """Best rows of one block for the anchors of one chunk and their windows."""
    def run(block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor": [], "win": [], "rid": [], "vec_id": [], "score": []}
        if len(block) and len(anchors):
            top = max(float(np.abs(np.concatenate(d["q"].to_numpy())).max(initial=0)) for d in (block, anchors))
            q, a = matrix(block["q"], top), matrix(anchors["q"], top)
            lists, rid, vec_id, label = Lists(q), block["rid"].to_numpy(), block["vec_id"].to_numpy(), block["label"].to_numpy()
            for i, (own, own_label, wins) in enumerate(zip(anchors["rid"], anchors["label"], anchors["wins"])):
                if other_label:  # windows under the positives' scores; a negative score has an empty one
                    wins = [int(w) for w in wins if w >= 0]
                    lo, hi = [-(-LOW * w // HIGH) for w in wins], wins
                    allowed = label != own_label
                else:
                    wins, lo, hi, allowed = [0], [-np.inf], [np.inf], rid != own
                if not wins:
                    continue
                rows, s = lists.search(a[i], np.array(lo, dtype=a.dtype), np.array(hi, dtype=a.dtype), k, allowed)
                for w in range(len(wins)):
                    fits = np.flatnonzero((s >= lo[w]) & (s <= hi[w]))
                    if len(fits) > k:
                        fits = fits[s[fits] >= np.sort(s[fits])[-k]]
                    fits = fits[np.lexsort((rid[rows[fits]], vec_id[rows[fits]], -s[fits]))][:k]
                    out["anchor"] += [own] * len(fits)
                    out["win"] += [wins[w]] * len(fits)
                    out["rid"] += rid[rows[fits]].tolist()
                    out["vec_id"] += vec_id[rows[fits]].tolist()
                    out["score"] += [int(v) for v in s[fits]]
        return pd.DataFrame({c: pd.Series(v, dtype="int64") for c, v in out.items()})
    return run


FOUND = "anchor long, win long, rid long, vec_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per anchor and window over all blocks, with their rank."""
    w = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search(rows: DataFrame, anchors: DataFrame, keys: list[str], k: int, block: int, chunk: int, other_label: bool) -> DataFrame:
    """Every anchor against every block of the rows that agree with it on ``keys``."""
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of their own: both sides are ``rows``
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    asked = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / chunk).cast("int").alias("nc"))
    deal = sizes.join(asked, keys).checkpoint()
    part = lambda n: F.pmod(F.xxhash64(F.col("rid"), F.lit(n)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(deal, keys).withColumn("blk", part("nb")).withColumn("chk", every("nc")).drop("nb", "nc")
    right = anchors.join(deal, keys).withColumn("chk", part("nc")).withColumn("blk", every("nb")).drop("nb", "nc")
    on = [*keys, "blk", "chk"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(_tile(k, other_label), FOUND)
    return _best(found, k)


def mine(vectors: DataFrame, is_anchor: Column, k: int = K, block: int = BLOCK, chunk: int = CHUNK, vec_id: str = "vec_id",
         vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` reads column vec_id."""
    vec = F.col(vector).cast("array<double>")
    fine = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & vec.isNotNull() \
        & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.transform(vec, lambda v: v * SCALE).alias("q"))
    # floor of a double that stays a double: a long would overflow for large components
    rows = rows.withColumn("q", F.transform("q", lambda v: F.when(F.abs(v) < 2.0 ** 52, F.floor(v).cast("double")).otherwise(v))) \
        .distinct().withColumn("dim", F.size("q")).withColumn("rid", F.xxhash64("vec_id", "label", "q")).checkpoint()
    anchors = rows.where(is_anchor)
    positives = _search(rows, anchors.withColumn("wins", F.array().cast("array<long>")), ["dim", "label"], k, block, chunk,
                        False).drop("win").checkpoint()
    wins = positives.groupBy("anchor").agg(F.collect_set("score").alias("wins"))  # k scores at most
    asking = anchors.join(wins, anchors.rid == wins.anchor).drop("anchor")
    negatives = _search(rows, asking, ["dim"], k, block, chunk, True)
    named = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")) \
        .join(negatives.select("anchor", F.col("win").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                               F.col("score").alias("negative_score")), ["anchor", "positive_score"]) \
        .join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def query(spark, sf_dir: str) -> DataFrame:
    return mine(relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), F.col("vec_id") % 100 == 0)


#: every anchor against every row
ORACLE_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::double)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::bigint AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::int AS rank, n.vec_id AS negative_id, p.positive_score,
       n.score AS negative_score
FROM pos p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""
