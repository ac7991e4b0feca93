"""Operator 13: Merkle manifest of a dataset, checked leaf by leaf with a recursive query.

**Tree.** Every row is a leaf (hash of its length-prefixed fields). The leaves of a group ascend by id; runs of
``FANOUT`` = 2 consecutive nodes become their hash until one node, the group's subroot, remains. Subroots in
group order are the leaves of one more tree, whose last node is the root of the dataset.

**Stored levels.** Leaves get their positions from ranged running totals, so a group holding a third of all rows
is cut like any other. Levels are built ``STRIDE`` at a time: blocks of 2^STRIDE consecutive nodes are grouped,
hashed up to the block's top by array functions, and every node of the block's lowest level is stored as a row
(tree, level, idx) with the siblings on its way to the top, the top's hash, and the key of its parent row
(ptree, plevel, pidx): the top itself, one stored level up, or the subroot's leaf in the last tree. Each stored
level is a Parquet folder under the shared checkpoint directory and the next one is built from it.

**Climb.** A recursive query starts at the leaf rows (tampered leaves with their tampered hash) and joins the upper
node rows on the key: each step appends the siblings it passes to the leaf's proof, folds the hash with them, and moves
to the parent row, until the key is null. STRIDE tree levels a step keep the steps few, and with them the rows that
the recursion moves. Spark's limit on rows of a recursion is lifted while it runs and put back afterwards; its result
is checkpointed.

Defined results: null fields hash as ``-``; a null group comes first; rows without id come first in their group
and are never tampered with; rows of equal id are ordered by leaf hash and each keep their own position (equal
rows are interchangeable); empty and very long texts are hashed whole; other input columns are ignored; an
empty table gives an empty result. Adding 1 to the largest long does not overflow (the sum is a decimal).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import running_total
from ..session import scratch_path

#: tree levels between stored levels, and climbed in one step of the recursion
STRIDE = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: the tree over the subroots
TOP = -1

NODE_SCHEMA = ("tree long, level int, idx long, sibs array<binary>, top binary, m long, ptree long, plevel int, "
               "pidx long, last boolean")


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


#: all levels of a block, from its nodes' hashes up to its top
_LEVELS = """aggregate(slice(sequence(1, {stride}), 1, height), array(n.h), (up, t) -> array_append(up, transform(
    sequence(0, (size(element_at(up, -1)) - 1) div 2), i -> unhex(sha2(concat(lower(hex(get(element_at(up, -1), 2 * i))),
    coalesce(lower(hex(get(element_at(up, -1), 2 * i + 1))), '')), 256)))))"""


def store_level(nodes: DataFrame, level: int, top_tree: bool, stride: int) -> DataFrame:
    """Node rows of one stored level from (tree, idx, h, m); m is the number of nodes of the tree at this level.

    Leaves keep what else they carry (id, start).
    """
    kept = [c for c in nodes.columns if c not in ("tree", "idx", "h", "m")]
    block = nodes.groupBy("tree", F.expr(f"shiftright(idx, {stride})").alias("blk")).agg(
        F.max("m").alias("m"), F.array_sort(F.collect_list(F.struct("idx", "h", *kept))).alias("n"))
    block = block.withColumn("height", F.expr(f"least({stride}, CASE WHEN m > 1 THEN length(bin(m - 1)) ELSE 0 END)")) \
        .withColumn("levels", F.expr(_LEVELS.format(stride=stride)))
    rows = block.select("tree", "blk", "m", F.expr("get(element_at(levels, -1), 0)").alias("top"), F.expr(
        "transform(n, (x, i) -> struct(x AS node, transform(slice(levels, 1, height), (a, t) -> "
        "get(a, cast(shiftright(i, t) ^ 1 as int))) AS sibs))").alias("each"))
    # outer: otherwise a filter on "each" is inferred, pushed below and computes the levels once more
    rows = rows.select("tree", "blk", "m", "top", F.posexplode_outer("each").alias("i", "each"))
    last = F.col("m") <= (1 << stride)
    end = F.lit(None) if top_tree else F.lit(TOP)
    return rows.select(
        "tree", F.lit(level).alias("level"), (F.col("blk") * (1 << stride) + F.col("i")).alias("idx"), "each.sibs", "top", "m",
        F.when(last, end.cast("long")).otherwise(F.col("tree")).alias("ptree"),
        F.when(last, F.lit(None if top_tree else 0).cast("int")).otherwise(F.lit(level + 1)).alias("plevel"),
        F.when(last, F.lit(None).cast("long") if top_tree else F.col("tree")).otherwise(F.col("blk")).alias("pidx"),
        last.alias("last"), *([F.col("each.node.h").alias("leaf")] if kept else []), *[f"each.node.{c}" for c in kept])


def store_tree(leaves: DataFrame, path: str, top_tree: bool, stride: int = STRIDE) -> tuple[DataFrame, list[str]]:
    """Store the levels of the trees over ``leaves`` (tree, idx, h, m): (tree, h) of their last nodes and the folders."""
    spark = leaves.sparkSession
    nodes, folders, ends = leaves, [], None
    while True:
        folders.append(f"{path}/{'top' if top_tree else 'groups'}-{len(folders):03d}")
        store_level(nodes, len(folders) - 1, top_tree, stride).write.parquet(folders[-1])
        stored = spark.read.schema(NODE_SCHEMA).parquet(folders[-1]).where(f"idx % {1 << stride} = 0")
        done = stored.where("last").select("tree", F.col("top").alias("h"))
        ends = done if ends is None else ends.unionByName(done)
        nodes = stored.where("not last").select(
            "tree", F.col("pidx").alias("idx"), F.col("top").alias("h"),
            F.ceil(F.col("m") / (1 << stride)).cast("long").alias("m"))
        if nodes.isEmpty():
            return ends, folders


#: a node row's siblings folded into a hash, and appended to a proof
_FOLD = """aggregate(transform({n}.sibs, (x, t) -> struct(x AS x, shiftright({n}.idx, t) & 1 AS right)), {start},
    (f, s) -> unhex(sha2(CASE WHEN s.x IS NULL THEN lower(hex(f)) WHEN s.right = 1 THEN concat(lower(hex(s.x)), lower(hex(f)))
                              ELSE concat(lower(hex(f)), lower(hex(s.x))) END, 256)))"""
_APPEND = "aggregate({n}.sibs, {start}, (p, x) -> CASE WHEN x IS NULL THEN p ELSE concat(p, x) END)"

CLIMB = f"""
WITH RECURSIVE climb (id, leaf, tree, level, idx, folded, proof, subroot, root) AS (
    SELECT l.id, l.leaf, l.ptree, l.plevel, l.pidx, {_FOLD.format(n='l', start='l.start')},
           {_APPEND.format(n='l', start="cast('' AS binary)")}, CASE WHEN l.last THEN l.top END, cast(NULL AS binary)
    FROM {{leaves}} l
    UNION ALL
    SELECT c.id, c.leaf, n.ptree, n.plevel, n.pidx, {_FOLD.format(n='n', start='c.folded')},
           {_APPEND.format(n='n', start='c.proof')},
           CASE WHEN n.last AND n.ptree IS NOT NULL THEN n.top ELSE c.subroot END,
           CASE WHEN n.last AND n.ptree IS NULL THEN n.top END
    FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx)
SELECT id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root,
       sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded_root, folded = root AS verified
FROM climb WHERE root IS NOT NULL
"""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every leaf row with its proof, folded from its hash ``start`` up to the root."""
    spark = leaves.sparkSession
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return spark.sql(CLIMB, leaves=leaves, nodes=nodes).checkpoint()
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)


def manifest(rows: DataFrame, row_id: str, group: str, fields: list[Column], tampered: list[Column] | None = None,
             stride: int = STRIDE) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per input row.

    ``fields`` are hashed into the leaf, ``tampered`` (same order) into the hash that the climb starts from.
    """
    spark = rows.sparkSession
    start = leaf_hash(*(tampered or fields))
    hashed = rows.select(F.col(group).alias("grp"), F.col(row_id).alias("id"), F.unhex(leaf_hash(*fields)).alias("leaf"),
                         F.unhex(start).alias("start"))
    placed = running_total(hashed, ["grp", "id", "leaf", "start"], out="at").checkpoint()
    groups = placed.groupBy("grp").agg(F.min("at").alias("base"), F.count("*").alias("m"))
    groups = running_total(groups, ["grp"], out="tree").checkpoint()
    leaves = placed.join(groups, placed.grp.eqNullSafe(groups.grp)).select(
        "tree", (F.col("at") - F.col("base")).alias("idx"), F.col("leaf").alias("h"), "m", "id", "start")
    path = scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    ends, low = store_tree(leaves, path, False, stride)
    high = store_tree(ends.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "h",
                                  F.lit(ends.count()).cast("long").alias("m")), path, True, stride)[1]
    return climb(spark.read.parquet(low[0]), spark.read.schema(NODE_SCHEMA).parquet(*low[1:], *high))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    n = F.col("n_chars")
    changed = F.when(hit, (n.cast("decimal(20,0)") + 1).cast("string")).otherwise(n.cast("string"))
    fields = [F.col(c) for c in FIELDS]
    return manifest(docs, "doc_id", "lang", fields, [changed if c == "n_chars" else F.col(c) for c in FIELDS]) \
        .withColumnRenamed("id", "doc_id")


def _leaf_sql(n_chars: str) -> str:
    def part(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar END"
    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: crc32 bit by bit: per byte, eight shifts with the reflected polynomial
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
    lambda ch: ascii(ch)::bigint)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, z: xor(x >> 1, 3988292384::bigint * (x & 1)))))"""

ORACLE_SQL = f"""
WITH RECURSIVE base AS (
    SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
           CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql('(n_chars::hugeint + 1)')} ELSE {_leaf_sql('n_chars')} END AS start
    FROM documents),
leaves AS (
    SELECT doc_id, leaf, start, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, start) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS m FROM base),
low AS (
    SELECT tree::bigint AS tree, 0 AS level, idx::bigint AS idx, leaf AS h, m::bigint AS m FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(m) + 1) // 2
    FROM low WHERE m > 1 GROUP BY tree, level, idx // 2),
high AS (
    SELECT -1::bigint AS tree, 0 AS level, tree AS idx, h, count(*) OVER () AS m FROM low WHERE m = 1
    UNION ALL
    SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (max(m) + 1) // 2
    FROM high WHERE m > 1 GROUP BY tree, level, idx // 2),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
climb AS (
    SELECT doc_id, leaf, tree::bigint AS tree, 0 AS level, idx::bigint AS idx, start AS folded, '' AS proof,
           NULL::varchar AS subroot, NULL::varchar AS root FROM leaves
    UNION ALL
    SELECT c.doc_id, c.leaf, CASE WHEN n.m > 1 THEN c.tree WHEN c.tree >= 0 THEN -1 ELSE -2 END,
           CASE WHEN n.m > 1 THEN c.level + 1 ELSE 0 END,
           CASE WHEN n.m > 1 THEN c.idx // 2 ELSE greatest(c.tree, 0) END,
           CASE WHEN n.m = 1 THEN c.folded WHEN c.idx % 2 = 1 THEN sha256(s.h || c.folded)
                ELSE sha256(c.folded || coalesce(s.h, '')) END,
           CASE WHEN n.m = 1 THEN c.proof ELSE c.proof || coalesce(s.h, '') END,
           CASE WHEN n.m = 1 AND c.tree >= 0 THEN n.h ELSE c.subroot END,
           CASE WHEN n.m = 1 AND c.tree = -1 THEN n.h END
    FROM climb c JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.idx = c.idx
    LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.idx = xor(c.idx, 1::bigint))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb WHERE root IS NOT NULL
"""
