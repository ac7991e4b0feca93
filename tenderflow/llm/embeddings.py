"""Operator 10: embedding near-duplicates with randomised-rotation binary codes.

**Codes.** A unit vector x of d dimensions is turned by a random orthonormal map into D > d
dimensions and only the signs are kept: x_code = sign(P x) / sqrt(D). The stored correction factor
f = <x_code, P x> makes P^T x_code / f an unbiased reconstruction of x (its error is orthogonal to
x). Each vector has two codes under independent maps A and B, so the errors of x under A and of y
under B are independent and

    estimate = (<x_A, y_B> + <x_B, y_A>) / 2        (reconstructions)

is an unbiased estimate of <x, y>. Its standard deviation at a true cosine t follows from the
factors alone: per term r_x^2 s^2 / (D - 1) + r_y^2 s^2 / (D - 1) + r_x^2 r_y^2 d / D^2, with
r = sqrt(1 - f^2) / f and s^2 = 1 - t^2. A pair whose estimate lies more than ``sigmas`` deviations
under the threshold is ruled out; every other pair is recomputed exactly in double precision.

**Candidates.** Pairs are estimated only if they share a key: the label and ``bits`` sign bits of one
of several bands of the codes. Sign bits of a pair at cosine t agree with probability
1 - arccos(t) / pi each, so the number of bands that reaches ``recall`` at the threshold follows by
formula; key width grows with log2 of the largest label, which keeps groups small at any size. A
pair is compared only in the first band that it shares: no pair is counted twice.

**Two passes.** Pass 1 moves codes and factors (tens of bytes a row) to the bands and returns the
rows that have a surviving pair, at most one row per vector and band. Pass 2 fetches whole vectors
for those rows alone and does the exact recomputation. Both compare in tiles of bounded size, so a
label or vector with a third of all rows is spread over tasks. Neither returns pairs: a tile
returns link counts per vector and a spanning forest of its links; components come from star
contraction. Equal vectors of a label are one class with a multiplicity throughout.

Recall against brute force is measured in tests/llm (1.0 on the test data; 0.9999 by formula for
pairs exactly at the threshold, more above it). Precision is 1: every link is checked exactly.

Defined results: a vector links with nothing (n_links 0, its own component) if its label is null, or
the vector is null, empty, zero, or holds null or non-finite components. Vectors are scaled
(exactly) before anything is squared, so large and small finite ones link alike. Vectors of different
length do not link. A row without vec_id links with nothing and has component_id null, kept
false. Repeated rows each come back and count as vectors of their own. Other input columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import tiles as T
from ..operators.components import connected

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.98
RECALL = 0.9999
SIGMAS = 5.0
SEED = 10
#: rows of a group compared in one task; larger groups are cut into blocks
BLOCK = 1 << 13
#: pairs estimated or recomputed at a time inside a task
PAIRS = 1 << 18


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a band key, number of bands) for labels of up to ``n`` vectors."""
    bits = min(max(math.ceil(math.log2(max(n, 2))) - 1, 8), 24)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


#: maps made so far in this process, by (dim, wide, which, seed)
_MAPS: dict[tuple[int, int, int, int], np.ndarray] = {}


def rotation(dim: int, wide: int, which: int, seed: int = SEED) -> np.ndarray:
    """A random orthonormal map from ``dim`` to ``wide`` dimensions (wide x dim)."""
    key = (dim, wide, which, seed)
    if key not in _MAPS:
        g = np.random.default_rng([seed, which, dim, wide]).standard_normal((wide, wide))
        q, r = np.linalg.qr(g)
        _MAPS[key] = np.ascontiguousarray((q * np.sign(np.diag(r)))[:, :dim])
    return _MAPS[key]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two (exactly) to components below 1, so that no finite vector's norm overflows."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def encode(x: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n x wide/4 bytes: map A then map B) and correction factors (n x 2) of the rows of x."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    codes, factors = [], []
    for which in (0, 1):
        o = u @ rotation(x.shape[1], wide, which).T
        codes.append(np.packbits(o > 0, axis=1))
        factors.append(np.abs(o).sum(axis=1) / math.sqrt(wide))
    return np.concatenate(codes, axis=1), np.stack(factors, axis=1)


def reconstruct(codes: np.ndarray, factors: np.ndarray, dim: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased reconstructions under map A and map B."""
    sign = np.unpackbits(codes, axis=1).astype(np.float64) * 2 - 1
    return tuple(sign[:, w * wide:(w + 1) * wide] @ rotation(dim, wide, w) / (math.sqrt(wide) * factors[:, w:w + 1])
                 for w in (0, 1))


def lower_limit(fa: np.ndarray, fb: np.ndarray, dim: int, wide: int, threshold: float, sigmas: float) -> np.ndarray:
    """The estimate below which a pair with factors fa, fb is ruled out."""
    ra, rb = (np.maximum(1 - f ** 2, 0) / f ** 2 for f in (fa, fb))  # squared error norms, one column per map
    s2 = 1 - threshold ** 2
    var = sum(ra[:, i] * s2 / (wide - 1) + rb[:, j] * s2 / (wide - 1) + ra[:, i] * rb[:, j] * dim / wide ** 2
              for i, j in ((0, 1), (1, 0))) / 4
    return threshold - sigmas * np.sqrt(var)


def band_keys(codes: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """n x bands integers: consecutive runs of ``bits`` sign bits."""
    flat = np.unpackbits(codes, axis=1)[:, :bits * bands].reshape(len(codes), bands, bits).astype(np.int64)
    return flat @ (1 << np.arange(bits, dtype=np.int64))


def pairs_in(pdf: pd.DataFrame, seg: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row index pairs of every tile, a bounded number at a time; across blocks only in a cross tile."""
    blk, cross = pdf["blk"].to_numpy(), pdf["ti"].to_numpy() != pdf["tj"].to_numpy()
    size = np.bincount(seg)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    small = size[seg] <= 32
    for step in range(1, 32):
        a = np.flatnonzero(small[:-step] & (seg[:-step] == seg[step:])) if len(seg) > step else np.zeros(0, int)
        if not len(a):
            break
        b = a + step
        ok = ~cross[a] | (blk[a] != blk[b])
        yield a[ok], b[ok]
    for g in np.flatnonzero(size > 32):
        rows = np.arange(start[g], start[g] + size[g])
        if cross[start[g]]:
            left, right = rows[blk[rows] == blk[rows].min()], rows[blk[rows] != blk[rows].min()]
            each = max(1, PAIRS // max(len(right), 1))
            for at in range(0, len(left), each):
                part = left[at:at + each]
                yield np.repeat(part, len(right)), np.tile(right, len(part))
        else:
            each = max(1, PAIRS // len(rows))
            for at in range(0, len(rows), each):
                a, b = np.meshgrid(rows[at:at + each], rows, indexing="ij")
                ok = a < b
                yield a[ok], b[ok]


def surviving(codes: np.ndarray, factors: np.ndarray, dim: int, wide: int, bits: int, bands: int, threshold: float,
              sigmas: float, pdf: pd.DataFrame, seg: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that this band owns and that the estimate does not rule out."""
    keys = band_keys(codes, bits, bands)
    band = pdf["band"].to_numpy()
    ra, rb = reconstruct(codes, factors, dim, wide)
    for a, b in pairs_in(pdf, seg):
        same = keys[a] == keys[b]
        mine = same.argmax(axis=1) == band[a]
        a, b = a[mine], b[mine]
        est = (np.einsum("ij,ij->i", ra[a], rb[b]) + np.einsum("ij,ij->i", rb[a], ra[b])) / 2
        ok = est >= lower_limit(factors[a], factors[b], dim, wide, threshold, sigmas)
        yield a[ok], b[ok]


TILE = ["grp", "ti", "tj"]


def _codes(p: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                wide = p["wide"](int(dim))
                c, f = encode(scaled(np.stack(part["vec"].to_numpy())), wide)
                keys = band_keys(c, p["bits"], p["bands"])
                n = len(part)
                for t in range(p["bands"]):
                    yield pd.DataFrame({"cls": part["cls"].to_numpy(), "label": part["label"].to_numpy(), "dim": int(dim),
                                        "band": t, "key": keys[:, t], "code": [x.tobytes() for x in c],
                                        "fa": f[:, 0], "fb": f[:, 1]}, index=range(n))
    return run


def _members(p: dict):
    """Pass 1: rows with a surviving pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in T.whole_groups(batches, TILE):
            for dim, pdf in whole.groupby("dim"):
                pdf, dim = pdf.reset_index(drop=True), int(dim)
                codes = np.frombuffer(b"".join(pdf["code"]), dtype=np.uint8).reshape(len(pdf), -1)
                hit = np.zeros(len(pdf), dtype=bool)
                for a, b in surviving(codes, pdf[["fa", "fb"]].to_numpy(), dim, p["wide"](dim), p["bits"], p["bands"],
                                      p["threshold"], p["sigmas"], pdf, T.segment_ids(pdf, TILE)):
                    hit[a] = True
                    hit[b] = True
                yield pdf.loc[hit, [*TILE, "blk", "band", "cls"]]
    return run


def _linked(p: dict):
    """Pass 2: exact cosines of the surviving pairs; per tile link counts and a forest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in T.whole_groups(batches, TILE):
            for dim, pdf in whole.groupby("dim"):
                pdf, dim = pdf.reset_index(drop=True), int(dim)
                x = scaled(np.stack(pdf["vec"].to_numpy()))
                norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                codes, factors = encode(x, p["wide"](dim))
                seg, cls, copies = T.segment_ids(pdf, TILE), pdf["cls"].to_numpy(), pdf["copies"].to_numpy()
                count, label, us, vs = np.zeros(len(pdf), dtype=np.int64), np.arange(len(pdf)), [], []
                for a, b in surviving(codes, factors, dim, p["wide"](dim), p["bits"], p["bands"], p["threshold"],
                                      p["sigmas"], pdf, seg):
                    ok = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= p["threshold"]
                    a, b = a[ok], b[ok]
                    np.add.at(count, a, copies[b])
                    np.add.at(count, b, copies[a])
                    while True:  # hook one new link per label until these links join nothing more
                        i = np.flatnonzero(label[a] != label[b])
                        if not len(i):
                            break
                        high, low = np.maximum(label[a[i]], label[b[i]]), np.minimum(label[a[i]], label[b[i]])
                        high, first = np.unique(high, return_index=True)
                        us.append(a[i[first]])
                        vs.append(b[i[first]])
                        to = np.arange(len(label))
                        to[high] = low[first]
                        while (to != to[to]).any():
                            to = to[to]
                        label = to[label]
                n = count > 0
                yield pd.DataFrame({"u": cls[n], "v": cls[n], "links": count[n]})
                if us:
                    u, v = np.concatenate(us), np.concatenate(vs)
                    yield pd.DataFrame({"u": cls[u], "v": cls[v], "links": np.zeros(len(u), dtype=np.int64)})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sigmas: float = SIGMAS,
                    block: int = BLOCK, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row."""
    vec = F.col(vector).cast("array<double>")
    fine = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) \
        & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) \
        & F.exists(vec, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), vec.alias("vec"),
                          F.coalesce(fine, F.lit(False)).alias("fine"))
    classes = rows.where("fine").groupBy("label", "vec").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies"))
    # one vec_id may come with several vectors: the class id tells them apart
    classes = classes.withColumn("cls", F.struct("cls", F.xxhash64("label", "vec").alias("h"))) \
        .withColumn("dim", F.size("vec"))
    ids = classes.select(F.xxhash64("cls.cls", "cls.h").alias("node"), F.col("cls.cls").alias("first"), "label", "vec",
                         "copies", "dim").checkpoint()
    top = ids.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, bands = plan(top, threshold, recall)
    p = {"bits": bits, "bands": bands, "threshold": threshold, "sigmas": sigmas,
         "wide": lambda dim: 64 * math.ceil(max(2 * dim, bits * bands / 2) / 64)}

    coded = ids.select(F.col("node").alias("cls"), F.xxhash64("label").alias("label"), "vec", "dim") \
        .mapInPandas(_codes(p), "cls long, label long, dim int, band int, key long, code binary, fa double, fb double")
    grouped = coded.select(F.xxhash64("label", "dim", "band", "key").alias("grp"), "cls", "dim", "band", "code", "fa", "fb")
    members = T.dealt(T.tiled(grouped, "grp", "cls", block), "grp") \
        .mapInPandas(_members(p), "grp long, ti int, tj int, blk int, band int, cls long").checkpoint()
    full = members.join(ids.select(F.col("node").alias("cls"), "vec", "copies", "dim"), "cls")
    linked = T.dealt(full, "grp").mapInPandas(_linked(p), "u long, v long, links long").checkpoint()

    counts = linked.where("links > 0").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected(linked.where("links = 0"))
    named = ids.join(counts, "node", "left").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    low = named.groupBy("root").agg(F.min("first").alias("component_id"))
    result = named.join(low, "root").select("label", "vec", "component_id",
                                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    keyed = rows.where("fine").select("vec_id", "label", "vec").join(result, ["label", "vec"])
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return keyed.select("vec_id", "n_links", "component_id").unionByName(alone) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
