"""Keyed loading (K1-K15, W1, W2): key checks, keep-first/last, insert-if-absent, upsert, sinks.

Keep-first / keep-last are aggregations (``min``/``max`` of a struct ordered
by the tie-break columns), not windows: the partial aggregate runs map-side,
so a key that holds a large share of the rows is reduced before the
shuffle instead of being sorted in one task.

Merges into a stored table rewrite the key buckets that a batch touches, through
Spark's dynamic partition overwrite (no table-format jar is assumed).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, pk: list[str], order: list[str], first: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in pk]
    ordered = [c for c in order if c not in pk] + [c for c in rest if c not in order]
    st = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])
    agg = (F.min(st) if first else F.max(st)).alias("_row")
    out = df.groupBy(*pk).agg(agg)
    return out.select(*pk, *[F.col(f"_row._{i}").alias(c) for i, c in enumerate(ordered)]).select(*df.columns)


def keep_first(df: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """K2/W1 -- one row per key: the first by ``order`` (ties broken by the remaining columns)."""
    return _pick(df, pk, order, first=True)


def keep_last(df: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """W2 -- one row per key: the last by ``order``."""
    return _pick(df, pk, order, first=False)


def pk_violations(df: DataFrame, pk: list[str]) -> DataFrame:
    """K3 -- keys that occur more than once, or contain a null part: (pk..., n)."""
    null_key = F.greatest(*[F.col(c).isNull() for c in pk]) if len(pk) > 1 else F.col(pk[0]).isNull()
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null_key)


def check_primary_key(df: DataFrame, pk: list[str]) -> None:
    """K3 -- raise before writing when the key is not unique / not null."""
    bad = pk_violations(df, pk).limit(1).collect()
    if bad:
        raise ValueError(f"primary key {pk} violated, e.g. {bad[0].asDict()}")


def fk_orphans(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """K4 -- child rows whose non-null foreign key has no parent row (left anti join)."""
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)]).distinct()
    c = child.where(F.greatest(*[F.col(x).isNotNull() for x in fk]) if len(fk) > 1 else F.col(fk[0]).isNotNull())
    return c.join(p, fk, "left_anti")


def fk_summary(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str], name: str) -> DataFrame:
    """K4 report -- (fk, child_rows, orphan_rows) in one pass over the child (left join + counts)."""
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)]).distinct().withColumn("_hit", F.lit(True))
    j = child.select(*fk).join(p, fk, "left")
    return j.agg(F.lit(name).alias("fk"), F.count(F.lit(1)).alias("child_rows"),
                 F.count_if(F.col("_hit").isNull()).alias("orphan_rows"))


def insert_if_absent(existing: DataFrame, new: DataFrame, pk: list[str]) -> DataFrame:
    """K5 -- existing rows plus the new rows whose key is not there yet, one per key (ON CONFLICT DO NOTHING)."""
    return existing.unionByName(keep_first(new.join(existing.select(*pk), pk, "left_anti"), pk, pk))


def upsert(existing: DataFrame, new: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """K7 -- last write wins per key over existing + new (``order`` decides "last")."""
    return keep_last(existing.unionByName(new, allowMissingColumns=True), pk, order)


# ---- sinks -----------------------------------------------------------------
def append(df: DataFrame, path: str, fmt: str = "parquet", max_records_per_file: int | None = None, **options) -> None:
    """K1/K9/K14 -- append rows; ``max_records_per_file`` bounds output parts."""
    w = df.write.mode("append").format(fmt).options(**options)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The data at ``path``, or None if the path does not exist; any other failure is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_keyed(df: DataFrame, path: str, pk: list[str], mode: str = "fail", fmt: str = "parquet") -> None:
    """K1-K5 -- keyed append. ``fail``: check the key (in the batch and against the target) and write
    nothing on a violation; ``skip``: insert only absent keys."""
    spark = df.sparkSession
    existing = read_if_there(spark, path, fmt)
    if mode == "fail":
        check_primary_key(df, pk)
        if existing is not None and df.join(existing.select(*pk), pk, "left_semi").limit(1).count():
            raise ValueError(f"keys {pk} already present in {path}")
        append(df, path, fmt)
    elif mode == "skip":
        todo = df if existing is None else df.join(existing.select(*pk), pk, "left_anti")
        append(keep_first(todo, pk, pk), path, fmt)
    else:
        raise ValueError(mode)


def load_checked(df: DataFrame, path: str, pk: str, fks: dict[str, tuple[str, str]], mode: str = "fail",
                 fmt: str = "parquet") -> dict[str, int]:
    """K1/K3/K4/P2 -- write a table and check its keys in the same pass; returns what was counted.

    ``fks``: column -> (path, key column) of a table loaded before. Counted while the rows are written: rows, rows of
    a key beyond its first, null keys, and per foreign key the rows that fill it and those without a parent. With ``fail``
    an empty table, a repeated or null key or an orphan is an error (the folder must then not be used); with ``report``
    the counts alone tell.
    """
    spark = df.sparkSession
    # rows are numbered within their key as they stream by: one that repeats a million times is not gathered
    rows = df.withColumn("_more", (F.row_number().over(Window.partitionBy(pk).orderBy(pk)) > 1).cast("int"))
    metrics = [F.count("*").alias("rows"), F.sum("_more").alias("repeated"), F.count_if(F.col(pk).isNull()).alias("null_keys")]
    for n, (fk, (parent, key)) in enumerate(fks.items()):
        keys = spark.read.format(fmt).load(parent).select(F.col(key).alias(f"_p{n}")).distinct()
        rows = rows.join(keys, F.col(fk) == F.col(f"_p{n}"), "left")
        metrics += [F.count(fk).alias(f"filled {fk}"), F.count_if(F.col(fk).isNotNull() & F.col(f"_p{n}").isNull()).alias(f"orphans {fk}")]
    seen = Observation()
    rows.observe(seen, *metrics).select(*df.columns).write.mode("errorifexists").format(fmt).save(path)
    counts = {k: v or 0 for k, v in seen.get.items()}
    if mode == "fail":
        if not counts["rows"]:
            raise ValueError(f"{path}: no rows")
        wrong = {k: v for k, v in counts.items() if v and (k in ("repeated", "null_keys") or k.startswith("orphans"))}
        if wrong:
            raise ValueError(f"{path}: {wrong}")
    return counts


def dependency_order(keys: dict[str, tuple[str, dict]]) -> list[str]:
    """Tables (name -> (key, {column: (parent, key)})) with every parent before its children."""
    done: list[str] = []
    while len(done) < len(keys):
        ready = [t for t, (_, fks) in keys.items() if t not in done and all(p in done or p == t for p, _ in fks.values())]
        if not ready:
            raise ValueError(f"foreign keys form a circle: {sorted(set(keys) - set(done))}")
        done += ready
    return done


BUCKET = "key_bucket"


def merge_buckets(new: DataFrame, path: str, pk: list[str], order: list[str], mode: str = "upsert", buckets: int = 64) -> None:
    """K5/K7 -- merge a batch into a table kept in folders by key bucket; only the buckets it touches are read and written.

    ``upsert``: the last row by ``order`` per key; ``insert``: the first of the batch, and only where the key is absent. Both
    are idempotent. Spark's dynamic partition overwrite replaces the touched folders when the job commits; ``buckets`` must
    stay the same for a table.
    """
    spark = new.sparkSession
    pick = keep_last if mode == "upsert" else keep_first
    batch = pick(new, pk, order).withColumn(BUCKET, F.pmod(F.xxhash64(*pk), F.lit(buckets)).cast("int")).checkpoint()
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # ``buckets`` numbers at most
    if not touched:
        return
    old = read_if_there(spark, path)
    if old is not None:
        old = old.where(F.col(BUCKET).isin(touched)).select(*batch.columns)  # prunes to the touched folders
        batch = keep_last(old.unionByName(batch), [*pk, BUCKET], order) if mode == "upsert" \
            else old.unionByName(batch.join(old.select(*pk), pk, "left_anti").select(*batch.columns))
    batch.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a table kept by ``merge_buckets``."""
    table = read_if_there(spark, path)
    return None if table is None else table.drop(BUCKET)


def reindex(df: DataFrame, path: str, mapping: dict[str, str], computed: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """K15 -- copy into a new mapping: (column -> new type), plus ``computed`` columns over the columns so copied.

    A row with a value that does not fit its new type goes, as it was, to the conflicts; the others proceed. One pass
    writes both sides, as two folders of one table; returns (copied, conflicts), read back.
    """
    cast = {c: F.expr(f"try_cast(`{c}` as {t})") for c, t in mapping.items()}
    wrong = F.lit(False)
    for c, v in cast.items():
        wrong = wrong | (F.col(c).isNotNull() & v.isNull())
    new = df.select(F.struct(*df.columns).alias("before"), *[cast.get(c, F.col(c)).alias(c) for c in df.columns], wrong.alias("conflict"))
    new = new.select("*", *[v.alias(k) for k, v in (computed or {}).items()])
    kept = [c for c in new.columns if c not in ("before", "conflict")]
    new.select(F.when(F.col("conflict"), F.col("before")).alias("before"), F.when(~F.col("conflict"), F.struct(*kept)).alias("after"), "conflict") \
        .write.partitionBy("conflict").parquet(path)
    both = df.sparkSession.read.schema(new.select(
        F.col("before"), F.struct(*kept).alias("after"), "conflict").schema).parquet(path)
    return both.where("not conflict").select("after.*"), both.where("conflict").select("before.*")


def clear(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K10 -- replace the store by an empty frame with the same schema."""
    df.limit(0).write.mode("overwrite").format(fmt).save(path)


def count(df: DataFrame) -> DataFrame:
    """K11 -- document count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def query(df: DataFrame, condition=None, fields: list[str] | None = None, size: int | None = None) -> DataFrame:
    """K12/L1/L2 -- filter + projection + page size (the index's page, not a sample)."""
    out = df if condition is None else df.where(condition)
    out = out if fields is None else out.select(*fields)
    return out if size is None else out.limit(size)


def materialise(reports: dict, path: str) -> None:
    """K13 -- overwrite one table per report."""
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
