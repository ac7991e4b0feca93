"""Code hierarchies: CPV by digits (C1-C9), by parent pointer (C10-C14), NUTS (N1-N10), closure.

Dimensions are computed once per code list (a few thousand rows, bounded by
the code space) and joined with ``broadcast``; list columns are exploded,
looked up and regrouped on the row key, so a frame that is already
partitioned by that key is regrouped without another shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

CPV_MIN_RANK, CPV_MAX_RANK = 0, 4


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# C2 (without the existence gate) -- rank from trailing zeros
def digit_rank(code) -> Column:
    c = _c(code)
    return (F.when(c.endswith("000000"), 0).when(c.endswith("00000"), 1).when(c.endswith("0000"), 2)
            .when(c.endswith("000"), 3).otherwise(4))


def _significant(code) -> Column:
    return F.length(F.regexp_replace(_c(code), "0+$", ""))


def cpv_dim(codes: DataFrame, code: str = "code", label: str = "label") -> DataFrame:
    """C1-C4, C8 -- (code, label, rank, parent, anc0..anc4) for every code of the list.

    parent (C3): the longest strict prefix ancestor ``prefix(code,k) + zeros`` that
    exists, k <= 5 (<= significant-1 when fewer than 6 digits are significant).
    anc_r (C4): self when rank = r; null when the rank is below r, or the code is a
    division; else the longest existing strict ancestor of rank <= r.
    """
    base = codes.groupBy(F.col(code).alias("code")).agg(F.min(label).alias("label"))  # first match per code
    kmax = F.when(_significant("code") > 5, 5).otherwise(_significant("code") - 1)
    cands = base.select("code", F.explode(F.sequence(F.lit(1), F.greatest(kmax, F.lit(1)))).alias("k"), kmax.alias("kmax")) \
        .where(F.col("k") <= F.col("kmax")) \
        .withColumn("cand", F.expr("rpad(substring(code, 1, k), 8, '0')"))
    existing = cands.join(base.select(F.col("code").alias("cand")), "cand", "left_semi") \
        .withColumn("cand_rank", digit_rank("cand"))
    aggs = [F.max_by("cand", "k").alias("parent")]
    for r in range(CPV_MIN_RANK, CPV_MAX_RANK + 1):
        aggs.append(F.max_by(F.when(F.col("cand_rank") <= r, F.col("cand")),
                             F.when(F.col("cand_rank") <= r, F.col("k"))).alias(f"_a{r}"))
    anc = existing.groupBy("code").agg(*aggs)
    dim = base.withColumn("rank", digit_rank("code")).join(anc, "code", "left")
    for r in range(CPV_MIN_RANK, CPV_MAX_RANK + 1):
        dim = dim.withColumn(f"anc{r}", F.when(F.col("rank") == r, F.col("code"))
                             .when((F.col("rank") < r) | (F.col("rank") == 0), None).otherwise(F.col(f"_a{r}")))
    return dim.drop(*[f"_a{r}" for r in range(CPV_MIN_RANK, CPV_MAX_RANK + 1)])


def lookup(df: DataFrame, col: str, dim: DataFrame, key: str, values: list[str], prefix: str = "") -> DataFrame:
    """J5/J11 -- left join of a dimension; unknown keys give nulls."""
    d = dim.select(F.col(key).alias("_k"), *[F.col(v).alias(prefix + v) for v in values])
    return df.join(d, F.col(col) == F.col("_k"), "left").drop("_k")


def cpv_parent_by_rank(df: DataFrame, col: str, dim: DataFrame, rank: int | str, out: str) -> DataFrame:
    """C4 -- scalar: ancestor of ``col`` at ``rank`` (a literal or a column name); null outside 0..4."""
    d = dim.select(F.col("code").alias("_k"), *[F.col(f"anc{r}").alias(f"_anc{r}") for r in range(5)])
    j = df.join(d, F.col(col) == F.col("_k"), "left")
    rk = F.lit(rank) if isinstance(rank, int) else F.col(rank)
    pick = F.element_at(F.array(*[F.col(f"_anc{r}") for r in range(5)]), (rk + 1).cast("int"))
    val = F.when((rk >= 0) & (rk <= 4), pick)
    return j.withColumn(out, val).drop("_k", *[f"_anc{r}" for r in range(5)])


def _explode_list(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.select(key, F.posexplode_outer(col).alias("_pos", "_code"))


def cpv_list_parents_by_rank(df: DataFrame, key: str, col: str, dim: DataFrame, rank: int, out: str) -> DataFrame:
    """C5 -- sorted distinct ancestors at ``rank`` of every code in a list; null when none / null list."""
    e = _explode_list(df, key, col)
    e = e.join(dim.select(F.col("code").alias("_code"), F.col(f"anc{rank}").alias("_v")), "_code", "left")
    g = e.groupBy(key).agg(F.array_sort(F.collect_set("_v")).alias(out))
    return df.join(g.withColumn(out, F.when(F.size(out) > 0, F.col(out))), key, "left")


def cpv_list_ranks(df: DataFrame, key: str, col: str, dim: DataFrame, out: str) -> DataFrame:
    """C6 -- ranks of a list, order kept, null for unknown codes; null list / empty list -> null."""
    e = _explode_list(df, key, col)
    e = e.join(dim.select(F.col("code").alias("_code"), F.col("rank").alias("_v")), "_code", "left")
    g = e.where(F.col("_pos").isNotNull()).groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_v"))), lambda x: x["_v"]).alias(out))
    return df.join(g, key, "left")


def cpv_list_parents(df: DataFrame, key: str, col: str, dim: DataFrame, out: str) -> DataFrame:
    """C7 -- sorted distinct ancestors at (own rank - 1) of every code of a list."""
    e = _explode_list(df, key, col)
    d = dim.select(F.col("code").alias("_code"),
                   F.when(F.col("rank") >= 1, F.element_at(F.array(*[F.col(f"anc{r}") for r in range(5)]),
                                                            F.col("rank"))).alias("_v"))
    e = e.join(d, "_code", "left")
    g = e.groupBy(key).agg(F.array_sort(F.collect_set("_v")).alias(out))
    return df.join(g.withColumn(out, F.when(F.size(out) > 0, F.col(out))), key, "left")


def list_labels(df: DataFrame, key: str, col: str, dim: DataFrame, out: str, code: str = "code",
                label: str = "label") -> DataFrame:
    """X11/D7 -- replace every code of a list by its label (order kept, null for unknown)."""
    e = _explode_list(df, key, col)
    e = e.join(dim.select(F.col(code).alias("_code"), F.col(label).alias("_v")), "_code", "left")
    g = e.where(F.col("_pos").isNotNull()).groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_v"))), lambda x: x["_v"]).alias(out))
    return df.join(g, key, "left")


# ---- parent-pointer taxonomies (C10-C14, N6-N10, J8) ---------------------
def ancestor_closure(dim: DataFrame, code: str = "code", parent: str = "parent") -> DataFrame:
    """J8 -- (code, ancestor, depth, known) for every code: depth 0 is the code itself.

    Walks parent pointers to the root, however deep, one join per level; the frontier of every level
    is checkpointed. A parent absent from the list is reached (one hop, ``known`` false) and ends the
    walk, as the reference walk does. A cycle is an error: some code would be its own ancestor.
    """
    nodes = dim.groupBy(F.col(code).alias("_n")).agg(F.min(parent).alias("_p")).checkpoint()
    frontier = nodes.select(F.col("_n").alias("code"), F.col("_n").alias("ancestor"), F.lit(0).alias("depth"),
                            F.lit(True).alias("known"), F.col("_p").alias("_next"))
    out = frontier.drop("_next")
    depth = 0
    while True:
        depth += 1
        nxt = frontier.where(F.col("_next").isNotNull() & F.col("known")) \
            .select("code", F.col("_next").alias("ancestor"), F.lit(depth).alias("depth"))
        frontier = nxt.join(nodes, F.col("ancestor") == F.col("_n"), "left") \
            .select("code", "ancestor", "depth", F.col("_n").isNotNull().alias("known"), F.col("_p").alias("_next")).checkpoint()
        if frontier.isEmpty():
            return out
        cyclic = frontier.where(F.col("code") == F.col("ancestor")).first()
        if cyclic is not None:
            raise ValueError(f"taxonomy has a cycle through {cyclic.code}")
        out = out.unionByName(frontier.drop("_next"))


def taxonomy_levels(dim: DataFrame, code: str = "code", parent: str = "parent", label: str = "label",
                    max_level: int = 5) -> DataFrame:
    """C12/C13/N9/N10 -- (code, level, lvl0..lvlN): level = hops to the top; lvl_k = ancestor at level k (k <= max_level)."""
    clo = ancestor_closure(dim, code, parent)
    lvl = clo.groupBy("code").agg(F.max("depth").alias("level"))
    j = clo.join(lvl, "code").withColumn("at_level", F.col("level") - F.col("depth"))
    piv = j.groupBy("code", "level").agg(*[F.max(F.when(F.col("at_level") == k, F.col("ancestor"))).alias(f"lvl{k}")
                                           for k in range(max_level + 1)])
    return piv


def nuts_code_by_level(df: DataFrame, col: str, nuts: DataFrame, level: int, out: str) -> DataFrame:
    """N5 -- prefix of length level+2, only when that code exists in the list."""
    from ..functions.columns import prefix_level
    df = df.withColumn("_cand", prefix_level(col, level))
    known = nuts.select(F.col("code").alias("_cand2")).distinct()
    j = df.join(known, F.col("_cand") == F.col("_cand2"), "left")
    return j.withColumn(out, F.when(F.col("_cand2").isNotNull(), F.col("_cand"))).drop("_cand", "_cand2")


def cpv_list_columns(df: DataFrame, key: str, col: str, dim: DataFrame, ranks: list[int] = (0, 1, 2, 3, 4),
                     labels: bool = True) -> DataFrame:
    """C5-C7 + X11 in one pass: explode every different code list once, join the dimension, regroup once.

    Adds ``cpv_parent`` (C7), ``cpv_level`` (C6, order kept), ``cpv<r>`` (C5) and replaces ``col`` by
    labels when ``labels``; sets are sorted by code and empty sets are null. ``key`` tells the rows apart. What is derived
    depends on the list alone: equal lists meet before they are dealt, and the rows join what their list gives. That is
    kept as a table first, so that its size is known when the join is planned: where it is small the rows stay where they are.
    """
    lab = dim.select(F.col("code").alias("_lc"), F.col("label").alias("_ll"))
    d = dim.select(F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("rank").alias("_rank"),
                   F.when(F.col("rank") >= 1, F.element_at(F.array(*[F.col(f"anc{r}") for r in range(5)]),
                                                           F.col("rank"))).alias("_par"),
                   *[F.col(f"anc{r}").alias(f"_a{r}") for r in ranks])
    for c in ["_par"] + [f"_a{r}" for r in ranks]:
        d = d.join(lab.select(F.col("_lc").alias(c), F.col("_ll").alias(c + "_l")), c, "left")
    lists = df.select(F.col(col).alias("_list")).where(F.size("_list") > 0).distinct()
    e = lists.select("_list", F.posexplode("_list").alias("_pos", "_code")).join(d, "_code", "left")

    def sorted_set(code_col: str, out: str):
        s = F.array_sort(F.collect_set(F.when(F.col(code_col).isNotNull(),
                                              F.struct(F.col(code_col).alias("c"), F.col(code_col + "_l").alias("l")))))
        v = F.transform(s, lambda x: x["l"] if labels else x["c"])
        return F.when(F.size(s) > 0, v).alias(out)

    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_rank", F.col("_label" if labels else "_code")
                                                   .alias("_v"))))
    aggs = [F.transform(ordered, lambda x: x["_rank"]).alias("cpv_level"),
            F.transform(ordered, lambda x: x["_v"]).alias("_listed"), sorted_set("_par", "cpv_parent")]
    aggs += [sorted_set(f"_a{r}", f"cpv{r}") for r in ranks]
    g, path = e.groupBy("_list").agg(*aggs), scratch_path(df.sparkSession, f"lists-{uuid.uuid4().hex}")
    g.write.option("compression", "zstd").parquet(path)
    g = df.sparkSession.read.schema(g.schema).parquet(path)
    out = df.join(g, F.col(col) == F.col("_list"), "left")
    return out.withColumn(col, F.col("_listed")).drop("_list", "_listed")
