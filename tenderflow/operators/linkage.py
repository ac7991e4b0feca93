"""Probabilistic record linkage (M1-M8, J9): candidates, comparison levels, Fellegi-Sunter, clusters.

The model compares all pairs of a block (``l.country = r.country``). Here only pairs that share a key
are compared, and the keys are chosen so that no pair that the model can lift to the threshold is
left out: the level combinations that reach it are worked out from the weights, and each must imply
a shared key (equal name, equal address, or a common one-character deletion of the name for
Damerau-Levenshtein distance 1, which covers transpositions). A model that lifts a combination
with no such key is refused with an error instead of losing its links.

* Records equal in block, name and address collapse into one profile (a group-by) if the model links
  such records; a null name or address is no evidence and merges nothing.
* Groups of a shared key are compared in tiles of bounded size (``operators.tiles``): a hot name or address is
  spread over tasks, and a tile returns its best links per profile and stars of what is connected, never all pairs.
* Levels are compared over arrays of pairs, distinct strings once, and only as far as a pair can still reach the threshold.
* Clusters are connected components by star contraction, with no limit on rounds.
* Every published link reaches the threshold: a record's probability is that of its best direct link.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import Pool, damerau_levenshtein, jaro_winkler, jaro_winkler_pairs, one_edit
from ..vocab import LINK_PRIOR, LINK_THRESHOLD
from . import tiles as T
from .components import connected

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: profiles of one key compared in one task; larger groups are cut into blocks
BLOCK = 2048
TILE = ["key", "ti", "tj"]

# ---- fixed values: default m / u probabilities of the comparison levels ----------
DEFAULT_MODEL = {
    "prior": LINK_PRIOR,
    "name": {"exact": (0.80, 0.0005), "dl1": (0.10, 0.001), "jw90": (0.05, 0.005), "jw80": (0.03, 0.01),
             "else": (0.02, 0.9835)},
    "address": {"exact": (0.75, 0.0002), "jw90": (0.15, 0.001), "jw70": (0.05, 0.01), "else": (0.05, 0.9888)},
}


def _norm(c: str):
    return F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))


# ---- levels and weights (M3-M5) ----------------------------------------------------
def name_level(a: str | None, b: str | None) -> str:
    if a is None or b is None:
        return "null"
    if a == b:
        return "exact"
    if abs(len(a) - len(b)) <= 1 and damerau_levenshtein(a, b) <= 1:
        return "dl1"
    jw = jaro_winkler(a, b)
    return "jw90" if jw >= 0.9 else "jw80" if jw >= 0.8 else "else"


def address_level(a: str | None, b: str | None) -> str:
    if a is None or b is None:
        return "null"
    if a == b:
        return "exact"
    jw = jaro_winkler(a, b)
    return "jw90" if jw >= 0.9 else "jw70" if jw >= 0.7 else "else"


def weight(model: dict, name: str, address: str) -> float:
    """log2 prior odds plus log2(m/u) of both levels; the null level is no evidence."""
    w = math.log2(model["prior"] / (1 - model["prior"]))
    for levels, level in ((model["name"], name), (model["address"], address)):
        if level in levels:
            m, u = levels[level]
            w += math.log2(m / u)
    return w


def probability(w: float) -> float:
    return 2.0 ** w / (1.0 + 2.0 ** w) if w < 1000 else 1.0


def lifting(model: dict, threshold: float) -> list[tuple[str, str]]:
    """The (name, address) level combinations that reach the threshold."""
    return [(n, a) for n, a in itertools.product([*model["name"], "null"], [*model["address"], "null"])
            if probability(weight(model, n, a)) >= threshold]


# ---- candidates (M2, J9) -----------------------------------------------------------
def profiles(df: DataFrame, uid: str, name: str, address: str, block: str, merge: bool = True) -> DataFrame:
    """(profile, block, name_n, address_n, uid): equal records without nulls share a profile (its smallest id)."""
    r = df.select(F.col(uid).cast("string").alias("uid"), _norm(name).alias("name_n"), _norm(address).alias("address_n"),
                  F.col(block).alias("block"))
    full = F.col("name_n").isNotNull() & F.col("address_n").isNotNull() & F.col("block").isNotNull()
    if not merge:
        return r.withColumn("profile", F.col("uid")).select("uid", "profile", "block", "name_n", "address_n")
    key = ["block", "name_n", "address_n"]
    p = r.where(full).groupBy(*key).agg(F.min("uid").alias("profile"))
    same = r.where(full).join(p, key).select("uid", "profile", *key)
    return same.unionByName(r.where(~full).select("uid", F.col("uid").alias("profile"), *key))


def _deletion_keys(name):
    """The name itself and every one-character deletion of it."""
    n = F.col(name)
    return F.array_union(F.array(n), F.transform(F.sequence(F.lit(1), F.greatest(F.length(n), F.lit(1))), lambda i: F.concat(
        F.substring(n, 1, i - 1), F.substring(n, i + 1, F.length(n)))))


def candidate_keys(prof: DataFrame, model: dict, threshold: float) -> DataFrame:
    """(key, profile, name_n, address_n): profiles under every key that a pair reaching the threshold may share."""
    p = prof.where("block is not null").select("profile", "block", "name_n", "address_n").distinct()
    kinds = set()
    for n, a in lifting(model, threshold):
        if n == "exact":
            kinds.add("name")
        elif a == "exact":
            kinds.add("deletion+address" if n == "dl1" else "address")
        elif n == "dl1":
            kinds.add("deletion")
        else:
            raise ValueError(f"levels name={n}, address={a} reach the threshold but imply no shared key")
    both = F.col("name_n").isNotNull() & F.col("address_n").isNotNull()
    keyed = {"name": (F.col("name_n").isNotNull(), F.array(F.struct("block", F.col("name_n").alias("x"), F.lit("").alias("y")))),
             "address": (F.col("address_n").isNotNull(), F.array(F.struct("block", F.lit("").alias("x"), F.col("address_n").alias("y")))),
             "deletion": (F.col("name_n").isNotNull(), F.transform(_deletion_keys("name_n"), lambda k: F.struct(
                 "block", k.alias("x"), F.lit("").alias("y")))),
             "deletion+address": (both, F.transform(_deletion_keys("name_n"), lambda k: F.struct(
                 "block", k.alias("x"), F.col("address_n").alias("y"))))}
    out = p.select(F.lit(0).cast("long").alias("key"), "profile", "name_n", "address_n").where("false")
    for kind in sorted(kinds):
        cond, keys = keyed[kind]
        some = p.where(cond).select("profile", "name_n", "address_n", F.explode(keys).alias("k"))
        # the hash only groups: whatever meets in a group is compared on its own strings
        out = out.unionByName(some.select(F.xxhash64(F.lit(kind), "k").alias("key"), "profile", "name_n", "address_n"))
    return out.distinct()


#: pairs that a step inside a task holds at a time
PAIRS = 1 << 18
NAME_LEVELS = ["exact", "dl1", "jw90", "jw80", "else", "null"]
ADDRESS_LEVELS = ["exact", "jw90", "jw70", "else", "null"]


def _distinct(measure, pool: Pool, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``measure`` of each pair, taken once for equal pairs."""
    pairs, at = np.unique(a.astype(np.int64) * len(pool.length) + b, return_inverse=True)
    return measure(pool, pairs // len(pool.length), pairs % len(pool.length))[at]


class Levels:
    """Comparison levels of arrays of pairs (M3, M4), worked out only as far as a pair can still be ``worth`` it.

    ``worth[name level, address level]`` says which combinations count. A level that is not known yet is a set of levels
    ("not equal", "more than one edit"); a pair is dropped once no combination of its sets counts.
    """

    UNEQUAL, FAR, OTHER = 6, 7, 5  # name: levels 1-4, levels 2-4; address: levels 1-3

    def __init__(self, pdf: pd.DataFrame, worth: np.ndarray):
        self.name, names = pd.factorize(pdf["name_n"])
        self.address, addresses = pd.factorize(pdf["address_n"])
        self.names, self.addresses = Pool(list(names)), Pool(list(addresses))
        rows = np.vstack([worth, worth[1:5].any(axis=0), worth[2:5].any(axis=0)])
        self.worth = np.column_stack([rows, rows[:, 1:4].any(axis=1)])

    def of(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions of the pairs that count, their name levels, their address levels), levels as numbers."""
        n1, n2, a1, a2 = self.name[i], self.name[j], self.address[i], self.address[j]
        name = np.where((n1 < 0) | (n2 < 0), 5, np.where(n1 == n2, 0, self.UNEQUAL))
        address = np.where((a1 < 0) | (a2 < 0), 4, np.where(a1 == a2, 0, self.OTHER))
        left = np.flatnonzero(self.worth[name, address])
        todo = left[name[left] == self.UNEQUAL]
        name[todo] = np.where(_distinct(one_edit, self.names, n1[todo], n2[todo]), 1, self.FAR)
        left = left[self.worth[name[left], address[left]]]
        todo = left[name[left] == self.FAR]
        jw = _distinct(jaro_winkler_pairs, self.names, n1[todo], n2[todo])
        name[todo] = np.where(jw >= 0.9, 2, np.where(jw >= 0.8, 3, 4))
        left = left[self.worth[name[left], address[left]]]
        todo = left[address[left] == self.OTHER]
        jw = _distinct(jaro_winkler_pairs, self.addresses, a1[todo], a2[todo])
        address[todo] = np.where(jw >= 0.9, 1, np.where(jw >= 0.7, 2, 3))
        left = left[self.worth[name[left], address[left]]]
        return left, name[left], address[left]


def _pairs(pdf: pd.DataFrame, segment: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of one tile, in steps of about ``PAIRS``; in a tile of two blocks, one row of each."""
    n = len(pdf)
    profile, blk = pd.factorize(pdf["profile"])[0], pdf["blk"].to_numpy()
    cross = (pdf["ti"] != pdf["tj"]).to_numpy()
    partners = np.searchsorted(segment, segment, side="right") - np.arange(n) - 1
    total = np.cumsum(partners)
    lo = 0
    while lo < n:
        hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, side="right")), lo + 1)
        i = np.repeat(np.arange(lo, hi), partners[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(partners[lo:hi]) - partners[lo:hi], partners[lo:hi])
        met = (profile[i] != profile[j]) & ~(cross[i] & (blk[i] == blk[j]))
        yield i[met], j[met]
        lo = hi


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each row's smallest row reachable by the links so far (``label``) and those of (i, j)."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]
    return label


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Whole tiles, rows by id inside a tile (greedy matching looks at the smaller id's string first), and tile numbers."""
    for pdf in T.whole_groups(batches, TILE):
        segment = T.segment_ids(pdf, TILE)
        order = np.lexsort((pdf["profile"].to_numpy().astype(str), segment))
        yield pdf.iloc[order].reset_index(drop=True), segment


def _compare(model: dict, threshold: float):
    odds = np.array([[probability(weight(model, n, a)) for a in ADDRESS_LEVELS] for n in NAME_LEVELS])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, segment in _batches(batches):
            levels = Levels(pdf, odds >= threshold)
            label, best = np.arange(len(pdf)), np.zeros(len(pdf))
            for i, j in _pairs(pdf, segment):
                at, name, address = levels.of(i, j)
                for side in (i[at], j[at]):
                    np.maximum.at(best, side, odds[name, address])
                label = _joined(label, i[at], j[at])
            profile = pdf["profile"].to_numpy()
            far, linked = np.flatnonzero(label != np.arange(len(pdf))), np.flatnonzero(best > 0)
            yield pd.DataFrame({"l": np.concatenate([profile[label[far]], profile[linked]]),
                                "r": np.concatenate([profile[far], profile[linked]]),
                                "match_probability": np.concatenate([np.full(len(far), np.nan), best[linked]])})
    return run


def links(prof: DataFrame, model: dict | None = None, threshold: float = LINK_THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(l, r, match_probability) over profiles: per tile, its smallest profile with each one that pairs reaching the threshold
    connect to it (no probability), and one row (p, p, best) per linked profile with the probability of its best pair."""
    model = model or DEFAULT_MODEL
    keyed = candidate_keys(prof, model, threshold).checkpoint()
    dealt = T.dealt(T.tiled(keyed, "key", "profile", block), "key") \
        .select("key", "ti", "tj", "blk", "profile", F.col("name_n"), F.col("address_n"))
    return dealt.mapInPandas(_compare(model, threshold), "l string, r string, match_probability double")


# ---- training (M5) -----------------------------------------------------------------
def pattern_counts(prof: DataFrame, model: dict | None = None, threshold: float = LINK_THRESHOLD,
                   block: int = BLOCK) -> DataFrame:
    """(gamma_name, gamma_address, n): level patterns of the candidate pairs; at most 6 x 5 rows."""
    model = model or DEFAULT_MODEL
    keyed = candidate_keys(prof, model, threshold)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = np.ones((len(NAME_LEVELS), len(ADDRESS_LEVELS)), dtype=bool)
        for pdf, segment in _batches(batches):
            levels, seen = Levels(pdf, every), np.zeros(every.size, dtype=np.int64)
            for i, j in _pairs(pdf, segment):
                _, name, address = levels.of(i, j)
                seen += np.bincount(name * len(ADDRESS_LEVELS) + address, minlength=every.size)
            yield pd.DataFrame([(n, a, c) for (n, a), c in zip(itertools.product(NAME_LEVELS, ADDRESS_LEVELS), seen) if c],
                               columns=["gamma_name", "gamma_address", "n"])
    dealt = T.dealt(T.tiled(keyed, "key", "profile", block), "key") \
        .select("key", "ti", "tj", "blk", "profile", F.col("name_n"), F.col("address_n"))
    return dealt.mapInPandas(count, "gamma_name string, gamma_address string, n long") \
        .groupBy("gamma_name", "gamma_address").agg(F.sum("n").alias("n"))


def em(patterns: DataFrame, model: dict | None = None, tol: float = 1e-6) -> dict:
    """M5 -- expectation-maximisation of the m/u probabilities on candidate pairs, until nothing moves by ``tol``.

    Only the counts of each (gamma_name, gamma_address) pattern leave Spark: at most 6 x 5 rows,
    whatever the number of pairs. The null level carries no evidence and is skipped; the returned
    model keeps the configured prior for two random records.
    """
    model = model or DEFAULT_MODEL
    counts = [(r.gamma_name, r.gamma_address, r.n)
              for r in patterns.collect()]
    comps = ("name", "address")
    m = {c: {lvl: v[0] for lvl, v in model[c].items()} for c in comps}
    u = {c: {lvl: v[1] for lvl, v in model[c].items()} for c in comps}
    lam = 0.5
    total = float(sum(n for _, _, n in counts)) or 1.0
    while counts:
        post = []
        for gn, ga, n in counts:
            pm, pu = lam, 1 - lam
            for c, lvl in zip(comps, (gn, ga)):
                if lvl in m[c]:
                    pm *= m[c][lvl]
                    pu *= u[c][lvl]
            post.append((gn, ga, n, pm / (pm + pu) if pm + pu > 0 else 0.0))
        new_lam = sum(n * p for _, _, n, p in post) / total
        new_m = {c: {} for c in comps}
        new_u = {c: {} for c in comps}
        for i, c in enumerate(comps):
            wm = sum(n * p for g in post for n, p in [(g[2], g[3])] if g[i] in m[c])
            wu = sum(n * (1 - p) for g in post for n, p in [(g[2], g[3])] if g[i] in m[c])
            for lvl in m[c]:
                em_ = sum(g[2] * g[3] for g in post if g[i] == lvl)
                eu_ = sum(g[2] * (1 - g[3]) for g in post if g[i] == lvl)
                # keep every level strictly inside (0, 1) so log-weights stay finite
                new_m[c][lvl] = min(max(em_ / wm if wm else m[c][lvl], 1e-6), 1 - 1e-6)
                new_u[c][lvl] = min(max(eu_ / wu if wu else u[c][lvl], 1e-6), 1 - 1e-6)
        delta = abs(new_lam - lam) + sum(abs(new_m[c][k] - m[c][k]) for c in comps for k in m[c])
        lam, m, u = new_lam, new_m, new_u
        if delta < tol:
            break
    return {"prior": model["prior"], **{c: {lvl: (m[c][lvl], u[c][lvl]) for lvl in m[c]} for c in comps}}


# ---- clusters and links (M1, M6-M8) --------------------------------------------------
def link(df: DataFrame, uid: str, name: str = "name", address: str = "address", block: str = "country",
         threshold: float = LINK_THRESHOLD, model: dict | None = None, train: bool = False,
         block_size: int = BLOCK) -> DataFrame:
    """M1/M6 -- (unique_id_src, unique_id_dst, match_probability): every input record exactly once as src.

    dst is the smallest id of the record's cluster (connected by pairs that reach the threshold) and
    match_probability that of the record's best pair, so no published link is below the threshold; a
    cluster's smallest record links to itself with probability 1.0.
    """
    return _links_of(df, uid, name, address, block, threshold, model, train, block_size, None)


def link_to_reference(new: DataFrame, reference: DataFrame, uid: str, name: str = "name", address: str = "address",
                      block: str = "country", threshold: float = LINK_THRESHOLD, model: dict | None = None,
                      train: bool = False, block_size: int = BLOCK) -> DataFrame:
    """M7 -- link records against an existing reference table: new and reference records are clustered together;
    every new record comes back once, pointing at its cluster's smallest reference id, or at the cluster's
    smallest new id if the cluster holds no reference record."""
    cols = [uid, name, address, block]
    both = new.select(*cols).unionByName(reference.select(*cols))
    known = reference.select(F.col(uid).cast("string").alias("uid")).distinct()
    out = _links_of(both, uid, name, address, block, threshold, model, train, block_size, known)
    return out.join(new.select(F.col(uid).cast("string").alias("unique_id_src")), "unique_id_src", "left_semi")


def grown_reference(reference: DataFrame, new: DataFrame, linked: DataFrame, uid: str) -> DataFrame:
    """M7 -- the reference table after a run: its records and the new ones that head a cluster of their own
    (``linked``: the result of ``link_to_reference``)."""
    heads = linked.where("unique_id_src = unique_id_dst").select(F.col("unique_id_src").alias("_head"))
    known = reference.select(F.col(uid).cast("string").alias("_known")).distinct()
    named = F.col(uid).cast("string")
    fresh = new.join(heads, named == F.col("_head"), "left_semi").join(known, named == F.col("_known"), "left_anti")
    return reference.unionByName(fresh.select(*reference.columns))


def _links_of(df, uid, name, address, block, threshold, model, train, block_size, known) -> DataFrame:
    model = model or DEFAULT_MODEL
    merge = probability(weight(model, "exact", "exact")) >= threshold
    prof = profiles(df, uid, name, address, block, merge).checkpoint()
    if train:  # estimate m/u on this data's candidate pairs first (M5)
        model = em(pattern_counts(prof, model, threshold, block_size), model)
        merge = probability(weight(model, "exact", "exact")) >= threshold
        prof = profiles(df, uid, name, address, block, merge).checkpoint()
    pairs = links(prof, model, threshold, block_size).checkpoint()
    best = pairs.where("l = r").groupBy(F.col("l").alias("profile")).agg(F.max("match_probability").alias("best"))
    roots = connected(pairs.where("l <> r").select(F.col("l").alias("u"), F.col("r").alias("v"))) \
        .select(F.col("node").alias("profile"), "root")
    rec = prof.select("uid", "profile").join(roots, "profile", "left").join(best, "profile", "left") \
        .withColumn("root", F.coalesce("root", "profile"))
    if known is None:
        ref = rec.groupBy("root").agg(F.min("uid").alias("dst"))
    else:
        old = known.withColumn("old", F.lit(1))
        ref = rec.join(old, "uid", "left").groupBy("root").agg(
            F.coalesce(F.min(F.when(F.col("old") == 1, F.col("uid"))), F.min("uid")).alias("dst"))
    # records of one profile are equal: they link as an exact pair even where nothing else does
    same = F.lit(probability(weight(model, "exact", "exact")))
    shared = prof.groupBy("profile").agg((F.count("*") > 1).alias("shared"))
    p = F.greatest("best", F.when(F.col("shared"), same))
    return rec.join(ref, "root").join(shared, "profile").select(
        F.col("uid").alias("unique_id_src"), F.col("dst").alias("unique_id_dst"),
        F.when(F.col("uid") == F.col("dst"), F.lit(1.0)).otherwise(p).alias("match_probability"))
