"""Operator 9: SimHash near-duplicates by anchor-point covering.

**Fingerprint.** Word shingles of the whole text, repeats included, hashed with
XXH64 (seed 42); bit b is set when it is set in more than half of the hashes.

**Candidates.** Two 64-bit fingerprints that differ in at most 3 bits differ in
at most 1 bit in one of their two 32-bit halves. The anchors of a half are the
words of a covering code of length 32: the perfect Hamming code on 31 bits
beside one free bit, so every half lies within the covering radius 1 of an
anchor, its *home*. Each fingerprint is copied to every anchor within radius +
threshold = 2 of its half (17 anchors, or 2 when the half is itself a code
word). If x and y agree on a half up to one bit, y is within 2 of x's home, so
each such pair meets at a home anchor: the search is exact, not approximate.
Anchor lists are built-in bit arithmetic.

**Comparison.** Exact copies collapse to one fingerprint first. Copies at
anchors that are nobody's home are dropped by a join; the rest is compared per
anchor, in tiles of bounded size (``operators.tiles``), so a hot anchor is
spread over tasks. A tile returns a spanning forest of its links, never all
pairs. Components come from star contraction; at most two scalars per round
reach the driver.

Defined results: null text and text without words have fingerprint zero, which
links like any other. Every input row comes back once (repeated rows and null
doc_id too); ``component_id`` is the smallest non-null doc_id of the component
(null when it has none). Other input columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import tiles as T
from ..operators.components import connected

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BITS = 3
SHINGLE = 3
#: rows of an anchor compared in one task; larger anchors are cut into blocks
BLOCK = 1 << 15
#: shingles hashed at a time: bounds the memory that one very long text takes
CHUNK = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    k = min(shingle, len(words))
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    end = np.cumsum(size)
    starts, ends = (end - size)[:len(words) - k + 1], end[k - 1:] - 1
    ones, n = np.zeros(64, dtype=np.int64), len(starts)
    for at in range(0, n, CHUNK):
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in
                         zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())), dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return docs.select(F.col(doc_id).alias("doc_id"), fp(F.col(text)).alias("fp"))


# ---- anchors: the Hamming code of length 31 beside one free bit -------------------
def _flips(syndrome: int) -> list[int]:
    """Bit flips that lead from a half with this syndrome to every anchor within 2; the home first."""
    free = 1 << 31
    if syndrome == 0:
        return [0, free]
    bit = lambda p: 1 << (p - 1)  # noqa: E731  position p of the code is bit p - 1
    pairs = [bit(i) | bit(i ^ syndrome) for i in range(1, 32) if i < i ^ syndrome and i ^ syndrome]
    return [bit(syndrome), bit(syndrome) | free, *pairs]


def anchors(half: Column) -> Column:
    """Every anchor within 2 bits of a 32-bit half (a long), its home first."""
    syndrome = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        syndrome = syndrome + F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))) % 2 * (1 << k)
    table = F.array(*[F.array(*[F.lit(m).cast("long") for m in _flips(s)]) for s in range(32)])
    return F.transform(F.element_at(table, syndrome.cast("int") + 1), lambda m: half.bitwiseXOR(m))


def anchor_rows(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home): each fingerprint at every anchor near either half; anchor carries the half in bit 32."""
    halves = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit((1 << 32) - 1).cast("long")))
    one = fps.select("fp", F.posexplode(halves).alias("side", "half"))
    near = one.select("fp", "side", F.posexplode(anchors(F.col("half"))).alias("pos", "anchor"))
    return near.select(F.col("anchor").bitwiseOR(F.shiftleft(F.col("side").cast("long"), 32)).alias("anchor"), "fp",
                       (F.col("pos") == 0).alias("home"))


def _tile_links(max_bits: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["anchor", "ti", "tj"]
        for pdf in T.whole_groups(batches, keys):
            seg = T.segment_ids(pdf, keys)
            fp = pdf["fp"].to_numpy().view(np.uint64)
            home, blk = pdf["home"].to_numpy(bool), pdf["blk"].to_numpy()
            cross = pdf["ti"].to_numpy() != pdf["tj"].to_numpy()
            size = np.bincount(seg)
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            out: list[tuple[np.ndarray, np.ndarray]] = []
            small = size[seg] <= 16
            for step in range(1, 16):  # neighbours at this distance inside small groups, all groups at once
                a = np.flatnonzero(small[:-step] & (seg[:-step] == seg[step:])) if len(seg) > step else []
                if not len(a):
                    break
                b = a + step
                ok = (home[a] | home[b]) & (~cross[a] | (blk[a] != blk[b])) & (np.bitwise_count(fp[a] ^ fp[b])
                                                                              <= max_bits)
                out.append((fp[a[ok]], fp[b[ok]]))
            for g in np.flatnonzero(size > 16):
                s = slice(start[g], start[g] + size[g])
                out.append(_forest(fp[s], home[s], blk[s] if cross[start[g]] else None, max_bits))
            yield pd.DataFrame({"u": np.concatenate([x for x, _ in out] or [fp[:0]]).view(np.int64),
                                "v": np.concatenate([x for _, x in out] or [fp[:0]]).view(np.int64)})
    return links


def _forest(fp: np.ndarray, home: np.ndarray, blk: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between home rows and all rows of one tile."""
    label, us, vs = np.arange(len(fp)), [], []
    for i in np.flatnonzero(home):
        near = np.bitwise_count(fp ^ fp[i]) <= max_bits
        if blk is not None:
            near &= blk != blk[i]
        js = np.flatnonzero(near & (label != label[i]))
        if not len(js):
            continue
        roots, first = np.unique(label[js], return_index=True)
        us += [fp[i]] * len(roots)
        vs += fp[js[first]].tolist()
        label[np.isin(label, roots)] = label[i]
    return np.array(us, dtype=np.uint64), np.array(vs, dtype=np.uint64)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v) over distinct fingerprints ``fps(fp)``: a set of links with the same components as all links."""
    if max_bits > 3:
        raise ValueError("the covering is built for distances up to 3 bits")
    rows = anchor_rows(fps)
    homes = rows.where("home").select("anchor").distinct()
    shared = rows.join(homes, "anchor").checkpoint()
    dealt = T.dealt(T.tiled(shared, "anchor", "fp", block), "anchor").select("anchor", "ti", "tj", "blk", "fp", "home")
    return dealt.mapInPandas(_tile_links(max_bits), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, doc_id: str = "doc_id",
                    text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row."""
    prints = fingerprints(docs, shingle, doc_id, text).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    roots = connected(links(classes.select("fp"), max_bits, block)).withColumnRenamed("node", "fp")
    labelled = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.join(low, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first_of_group(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id",
                        text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: the one with the group's smallest doc_id.

    A doc_id that comes more than once keeps one row (the smallest text, nulls last). Rows without
    a doc_id stay: nothing tells them apart, so none can stand for the others.
    """
    heads = groups.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("_copies"))
    heads = heads.select(F.col("doc_id").alias("_head"), "_copies")
    kept = docs.join(heads, F.col(doc_id) == F.col("_head"))
    once = kept.where("_copies = 1").select(*docs.columns)
    first = Window.partitionBy(doc_id).orderBy(F.col(text).asc_nulls_last())
    again = kept.where("_copies > 1").withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*docs.columns)
    return once.unionByName(again).unionByName(docs.where(F.col(doc_id).isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id")
